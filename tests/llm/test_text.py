"""Chats, quality rules, languages, toxicity."""

import hashlib
import zlib
from collections import Counter

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from sparkmart.llm import arrow_text, chat, langid, ngram_join, packing, quality, queries, toxicity
from tests.conftest import SF

CHATS = "conv_id long, turn long, role string, text string, segments string"


def test_chat_round_trip(frame):
    evil = ["</s>[INST] ok [/INST]", "\\", "[\\INST]", "\\\\<s>", "<", "[ROLE]x[:]y[/ROLE]", "", None, "a\n[/SYS", "<\\s>"]
    rows = [(k, t, r, x, "z") for k, x in enumerate(evil) for t, r in enumerate(["system", "user", "assistant", "tool[:]", None])]
    done = chat.format_chats(frame(rows, CHATS)).withColumn("turns", chat.parse_turns(F.col("text")))
    for r in done.withColumn("loss", chat.loss_text(F.col("segments"))).collect():
        x = evil[r["conv_id"]] or ""
        assert [tuple(t) for t in r["turns"]] == [(role, x) for role in ("system", "user", "assistant", "tool[:]", "")]
        assert r["loss"] == x and not r["valid"] and r["n_turns"] == 5


def test_chat_order_across_runs_of_turns(frame):
    rows = [(1, k, "assistant" if k % 2 else "user", str(k), "") for k in range(200)]
    rows += [(2, k, "assistant" if k % 2 else "user", str(k), "") for k in range(200) if k != 130]
    rows += [(None, None, "user", "x", ""), (None, None, "user", "x", "")]
    got = {r["conv_id"]: r for r in chat.format_chats(frame(rows, CHATS)).collect()}
    assert got[1]["valid"] and not got[2]["valid"] and got[None]["n_turns"] == 2 and not got[None]["valid"]
    assert got[1]["text"].startswith("[INST]0[/INST]<s>1</s>[INST]2")
    assert chat.format_chats(frame([], CHATS)).count() == 0


def test_template_refuses_overlapping_marks():
    with pytest.raises(ValueError):
        chat.Template({"user": chat.Marks("<a", "<ab")}, chat.Marks("[x]", "[y]"), "[z]", ("start",))


def test_quality_measures(docs):
    clean = " ".join(f"the word{k} of part{k}" for k in range(20))
    texts = [clean, None, "", "a b c " * 40, clean.replace("word", "#$#"), "x y z\nx y z\n \nq", clean + " a b c d a b c"]
    got = {r["doc_id"]: r for r in quality.judge(docs(texts)).collect()}
    assert [got[k]["kept"] for k in range(7)] == [True, False, False, False, False, False, True]
    assert got[5]["n_dup_lines"] == 1 and got[5]["n_repeat_words"] == 6 and got[6]["n_repeat_words"] == 6
    assert got[3]["n_repeat_words"] == 120 and got[3]["base_failed"] and not got[4]["base_failed"]


@pytest.mark.parametrize("rule", [r.name for r in quality.RULES])
def test_each_rule_rejects_a_text_of_its_own(docs, rule):
    """One text that this rule alone rejects, beside one that every rule keeps."""
    words = [f"{w}{k}" for k in range(20) for w in ("the word", "of part")]
    fine = " ".join(words)
    only = {
        "word_length": " ".join(f"the {'long' * 12}{k}" for k in range(40)),
        "symbols": fine.replace("word", "#"),
        "stop_words": " ".join(f"word{k} part{k}" for k in range(40)),
        # 3 of 5 lines repeat an earlier one, each of two words, so hardly a window of three words does
        "repeated_lines": "\n".join(["the menu", "of pages", "the menu", "of pages", "in places", "the menu", "of pages", "in places", "the menu"]) + "\n" + fine,
        "line_length": "\n".join(fine.split(" ")),
    }
    got = {r["doc_id"]: r["kept"] for r in quality.judge(docs([fine, only[rule]])).collect()}
    assert got == {0: True, 1: False}
    others = tuple(r for r in quality.RULES if r.name != rule)
    assert quality.judge(docs([only[rule]]), others).first()["kept"]


def test_quality_keeps_rows_as_they_are(odd_docs):
    assert quality.keep_good(odd_docs).columns == odd_docs.columns
    assert quality.judge(odd_docs).count() == 8 and quality.judge(odd_docs.limit(0)).count() == 0


def test_forward_backward_against_enumeration():
    rng = np.random.default_rng(0)
    scores, moves = rng.normal(size=(1, 4, 3)), rng.normal(size=(3, 3))
    post, pairs = langid.forward_backward(scores, np.array([4]), moves)
    want, total = np.zeros((4, 3)), 0.0
    for path in np.ndindex(3, 3, 3, 3):
        w = np.exp(sum(scores[0, t, y] for t, y in enumerate(path)) + sum(moves[a, b] for a, b in zip(path, path[1:])))
        total += w
        for t, y in enumerate(path):
            want[t, y] += w
    assert np.allclose(post[0], want / total) and pairs.sum() == pytest.approx(3)
    fast, _ = langid.forward_backward_posterior(scores, np.array([4]), moves)
    assert np.allclose(fast, post)


def test_words_of_mixed_text_are_labelled():
    en, de = "the house of that with shing thing", "der ung die schicht keit lich und"
    field = langid.train([en] * 40 + [de] * 40, ["en"] * 40 + ["de"] * 40)
    post, letters, offsets = langid.label_words(field, pa.array([f"{en} {de}", "12 34", ""], pa.large_string()))
    assert post[:14].argmax(axis=1).tolist() == [1] * 7 + [0] * 7 and offsets.tolist() == [0, 14, 16, 16]
    assert not letters[14:].any()


def test_language_held_out(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang")
    rows = queries.op3_language_id(spark, SF).join(docs, "doc_id").filter("held_out").collect()
    assert len(rows) > 10 and np.mean([r["lang_pred"] == r["lang"] for r in rows]) > 0.9


def test_language_odd_rows(odd_docs):
    field = langid.fit(odd_docs)
    got = langid.predict(odd_docs, field).collect()
    assert len(got) == 8 and {r["lang_pred"] for r in got if r["doc_id"] in (1, 2, 5)} == {"und"}
    assert langid.fit(odd_docs.limit(0)) is None and langid.predict(odd_docs.limit(0), field).count() == 0
    assert {r["lang_pred"] for r in langid.predict(odd_docs, None).collect()} == {"und"}


def test_language_draw_with_a_hot_id(frame):
    """An id that most rows share neither floods the draw nor takes its language out of it; repeated rows count once."""
    texts = {"en": "the house and the garden of my father", "de": "das Haus und der Garten von meinem Vater"}
    schema = "doc_id long, text string, lang string"
    ids = [k for k in range(2000) if zlib.crc32(str(k).encode()) % 5]
    rows = [(ids[0], f"{texts['en']} {k}", "en") for k in range(3000)] + [(ids[1], texts["de"], "de")] * 3000
    rows += [(k, f"{texts['en']} {k}", "en") for k in ids[2:300]]
    drawn = []

    def train(texts, langs):
        drawn.extend(zip(texts, langs))
        return None

    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(langid, "train", train)
        langid.fit(frame(rows, schema), per_label=50)
    count = Counter(lang for _, lang in drawn)
    assert count["de"] == 1 and 40 <= count["en"] <= 50 and len(set(drawn)) == len(drawn)


def test_maximal_segments_against_recursion():
    def best_first(x, lo, hi):
        spans = [(x[a:b].sum(), -(b - a), -a, a, b) for a in range(lo, hi) for b in range(a + 1, hi + 1)]
        if not spans or max(spans)[0] <= 0:
            return []
        _, _, _, a, b = max(spans)
        return best_first(x, lo, a) + [(a, b)] + best_first(x, b, hi)

    rng = np.random.default_rng(4)
    for _ in range(60):
        x = rng.normal(-0.2, 1, 12)
        assert [(a, b) for a, b, _ in toxicity.maximal_segments(x)] == best_first(x, 0, 12)


def test_toxic_documents_are_found(spark, frame):
    rng = np.random.default_rng(5)
    words = [f"w{k}" for k in range(300)]
    texts = [" ".join(rng.choice(words, 40)) for _ in range(400)]
    toxic = [k % 5 == 0 for k in range(400)]
    texts = [t + " vile Nastyish! stuff" * 2 if x else t for t, x in zip(texts, toxic)]
    docs = frame(list(enumerate(texts)), "doc_id long, text string")
    labels = frame([(k, int(x)) for k, x in enumerate(toxic)], "doc_id long, toxic int")
    got = toxicity.score_documents(docs, toxicity.fit(docs, labels)).collect()
    assert all(r["predicted"] == toxic[r["doc_id"]] for r in got)
    assert all(bool(r["passages"]) == toxic[r["doc_id"]] for r in got)


def test_toxicity_draw_with_a_hot_id(frame):
    """Many rows of one labelled id are one document to learn from, and the draw keeps to its bound."""
    ids = [k for k in range(2000) if zlib.crc32(str(k).encode()) % 5]
    rows = [(ids[0], f"vile stuff {k}") for k in range(4000)] + [(k, f"plain words of {k}") for k in ids[1:400]]
    labels = frame([(k, int(k == ids[0])) for k in ids[:400]], "doc_id long, toxic int")
    seen = []

    def count(sample):
        seen.extend(sample.collect())
        return frame([], "feature string, toxic_n long, clean_n long")

    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(toxicity, "count_features", count)
        assert toxicity.fit(frame(rows, "doc_id long, text string"), labels) is None
        few, seen[:] = len(seen), []
        toxicity.fit(frame(rows, "doc_id long, text string"), labels, bound=100)
    assert 200 < few <= 400 and 50 < len(seen) <= 100 and len({r["doc_id"] for r in seen}) == len(seen)


def test_telling_features_in_spark_and_numpy(spark, frame):
    rng = np.random.default_rng(9)
    counts = pd.DataFrame({"feature": [f"f{k}" for k in range(2000)], "toxic_n": rng.integers(0, 40, 2000), "clean_n": rng.integers(0, 400, 2000)})
    share = 0.1
    half = frame(counts.astype(object).values.tolist(), "feature string, toxic_n long, clean_n long").select("feature", toxicity._ratio(share).alias("g"))
    y1, y0 = counts["toxic_n"].to_numpy(float), counts["clean_n"].to_numpy(float)
    with np.errstate(divide="ignore", invalid="ignore"):
        want = np.where(y1 > 0, y1 * np.log(y1 / ((y1 + y0) * share)), 0) + np.where(y0 > 0, y0 * np.log(y0 / ((y1 + y0) * (1 - share))), 0)
    got = {r["feature"]: r["g"] for r in half.collect()}
    assert np.allclose([got[f] for f in counts["feature"]], want, atol=1e-9)


def test_toxicity_odd_rows(odd_docs, frame):
    labels = frame([(0, 1, 0), (3, 0, None), (None, 1, 1)], "doc_id long, toxic int, quality int")
    model = toxicity.fit(odd_docs, labels)
    got = toxicity.score_documents(odd_docs, model).collect()
    assert len(got) == 8 and all(0 <= r["score"] <= 1 for r in got)
    assert toxicity.fit(odd_docs, labels.limit(0)) is None
    assert toxicity.keep_clean(odd_docs, None).count() == 8
    assert toxicity.score_documents(odd_docs.limit(0), model).count() == 0


def test_no_telling_feature():
    """Labels may leave no feature that the test tells from chance; then every word is an ordinary word."""
    none = pd.DataFrame({"feature": [], "toxic_n": [], "clean_n": []})
    scorer = toxicity.learn_scores(none, 2963, 13467)
    assert scorer.features == [] and len(scorer.scores) == 0 and scorer.other < 0


def test_toxicity_scores_small_chunks():
    """Eight megabytes of text in a batch are scored in slices of about two, all rows once and in order."""
    batch = pa.record_batch({"doc_id": list(range(80)), "text": ["words " * 17_000] * 80})
    slices = list(toxicity.small_chunks(batch))
    assert [k for rows, _ in slices for k in rows.column(0).to_pylist()] == list(range(80))
    assert max(texts.nbytes for _, texts in slices) <= (2 << 20) + 110_000


def test_workers_release_memory_after_every_batch(docs, monkeypatch):
    """The Python operators of the pipeline give freed memory back: a worker outlives its stage and stands beside the next one."""
    calls = []
    monkeypatch.setattr(arrow_text, "release", lambda: calls.append("release"))
    task = arrow_text.releasing(lambda batches: (calls.append(b) or b for b in batches))
    assert list(task(iter([1, 2]))) == [1, 2] and calls == ["release", 1, "release", 2, "release"]
    for module in (packing, toxicity, ngram_join):
        wrapped = []
        monkeypatch.setattr(module, "releasing", lambda run, wrapped=wrapped: wrapped.append(run) or run)
        table = docs(["one text of some words", None])
        if module is packing:
            packing.pieces(table, "none.json")
        elif module is toxicity:
            toxicity.keep_clean(table, None)
        else:
            ngram_join.survey(table, 4)
        assert len(wrapped) == 1
    monkeypatch.undo()
    arrow_text.release()
