"""Mixing, whitening and alignment against plain versions."""

import hashlib
import math
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
from tokenizers import Tokenizer

from sparkmart.llm import alignment, mixing, queries, whitening
from tests.conftest import SF


def shared_out(sizes, weights, most):
    """Targets of sources in order, by resharing the excess until none is above."""
    free, left, target = set(range(len(sizes))), float(sum(sizes)), {}
    while free:
        unit = left / sum(weights[k % len(weights)] for k in free)
        above = {k for k in free if unit * weights[k % len(weights)] > most * sizes[k]}
        if not above:
            return [target.get(k, unit * weights[k % len(weights)]) for k in range(len(sizes))]
        for k in above:
            target[k] = most * sizes[k]
            left -= target[k]
        free -= above
    return [target[k] for k in range(len(sizes))]


def test_targets_stop_and_are_shared_again(frame):
    sizes = [100, 5, 1, 0, 40, 700, 2]
    table = frame([(f"0s{k}", n) for k, n in enumerate(sizes)], "src string, size long")
    got = [r["target"] for r in mixing.source_targets(table).orderBy("src").collect()]
    assert got == pytest.approx(shared_out(sizes, mixing.WEIGHTS, 3)) and sum(got) == pytest.approx(sum(sizes))


def test_mix_of_the_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = queries.op11_mixing(spark, SF).collect()
    words = {r["doc_id"]: (r["source"], len([w for w in r["text"].replace("\x0b", " ").replace("\x0c", " ").split(" ") if w.split()])) for r in docs.collect()}
    sizes = Counter()
    for r in docs.collect():
        sizes[r["source"]] += sum(len(x.split()) for x in r["text"].split(" "))
    names = sorted(sizes)
    targets = dict(zip(names, shared_out([sizes[s] for s in names], mixing.WEIGHTS, 3)))
    assert sorted(r["doc_id"] for r in rows) == sorted(words)
    taken, most = Counter(), Counter()
    for r in rows:
        assert r["source_size"] == sizes[r["source"]] and r["target"] == pytest.approx(targets[r["source"]])
        assert r["taken"] == r["copies"] * r["size"] and 0 <= r["copies"] <= 3
        taken[r["source"]] += r["taken"]
        most[r["source"]] = max(most[r["source"]], r["size"])
    for s in names:  # ten documents a source here, so one document is much
        assert abs(taken[s] - targets[s]) <= most[s]
    again = mixing.mix(docs.repartition(5)).select("doc_id", "taken").collect()
    assert sorted(map(tuple, again)) == sorted((r["doc_id"], r["taken"]) for r in rows)


def test_mix_meets_targets_of_many_documents(frame):
    pick = random.Random(2)
    rows = [(k, "w " * int(pick.lognormvariate(3, 1.5) + 1), pick.choice(["a", "a", "a", "b", None])) for k in range(3000)]
    got = mixing.mix(frame(rows, "doc_id long, text string, source string")).collect()
    for s in ("a", "b", None):
        own = [r for r in got if r["source"] == s]
        assert abs(sum(r["taken"] for r in own) / own[0]["target"] - 1) < 0.002
        rate = own[0]["target"] / own[0]["source_size"]
        assert all(math.floor(rate - 0.1) <= r["copies"] <= math.ceil(rate + 0.1) for r in own if r["size"] < 100)


def test_rounding_keeps_expectations_and_sums(frame):
    """Pairs keep the words of a source; over many seeds each node goes up as often as it should."""
    shares = [0.1, 0.25, 0.5, 0.5, 0.65, 0.9, 0.3, 0.8]
    nodes = frame([(f"0s{n}", n * 100 + k, x, 1.0, k) for n in range(300) for k, x in enumerate(shares)], "src string, h long, x double, s double, id long")
    ups = Counter()
    for r in mixing.round_copies(nodes, len(shares)).collect():
        ups[r["src"]] += r["up"]
        ups[r["id"]] += r["up"]
    assert all(ups[f"0s{n}"] == 4 for n in range(300))  # the shares add up to four
    assert all(abs(ups[k] / 300 - x) < 0.1 for k, x in enumerate(shares))


def test_mix_odd_rows(spark, odd_docs, frame):
    got = mixing.mix(odd_docs).collect()
    assert sorted((r["doc_id"], r["size"]) for r in got if r["doc_id"] is not None) == [(0, 210), (1, 0), (2, 0), (3, 30000), (4, 9), (4, 9), (5, 0)]
    assert [r["size"] for r in got if r["doc_id"] is None] == [8] and {r["source"] for r in got} == {"s", None}
    assert all(r["taken"] == 0 for r in got if not r["size"])
    assert mixing.mix(odd_docs.limit(0)).count() == 0
    assert [r["taken"] for r in mixing.mix(frame([(1, None, "x")], "doc_id long, text string, source string")).collect()] == [0]
    same = mixing.mix(frame([(1, "two words", "x")] * 40 + [(2, "more words than that", "y")] * 10, "doc_id long, text string, source string")).collect()
    assert len(same) == 50 and sum(r["taken"] for r in same) == pytest.approx(120, abs=4)


def plain_whitening(vectors, k=8):
    x = np.floor(1024 * np.array(vectors, float)) + 100_000
    centred = x - x.sum(0) / len(x)
    values, axes = np.linalg.eigh(centred.T @ centred / len(x))
    values, axes = values[::-1], axes[:, ::-1]
    return centred @ axes[:, :k] / np.sqrt(values[:k]), values[:k] / values.sum(), x


def test_whitening_of_the_table(spark):
    table = spark.read.parquet(f"{SF}/embeddings.parquet").orderBy("vec_id").collect()
    white, explained, x = plain_whitening([r["embedding"] for r in table])
    got = {(r["vec_id"], r["component"]): r for r in queries.op12_whitening(spark, SF).collect()}
    ids, n, total = [r["vec_id"] for r in table], len(table), [int(v) for v in x.sum(0)]
    assert len(got) == 8 * n
    for c in range(8):
        own = np.array([got[i, c + 1]["whitened"] for i in ids])
        sign = np.sign(own @ white[:, c])
        assert np.abs(own - sign * white[:, c]).max() < 1e-9
        assert got[ids[0], c + 1]["explained"] == pytest.approx(explained[c], rel=1e-10)
    for i, row in zip(ids, x):
        r = got[i, 1]
        assert r["deviation"] == sum((n * int(v) - s) ** 2 for v, s in zip(row, total)) and r["n"] == n and r["identity_error"] < 1e-10


def test_refinement_of_clustered_eigenvalues():
    rng = np.random.default_rng(0)
    q, _ = np.linalg.qr(rng.normal(size=(40, 40)))
    values = np.concatenate(([5, 5, 5 + 1e-9, 5 - 1e-9, 3, 3 + 1e-7, 1, 1, 1], rng.uniform(0, 1, 30), [0]))
    a = (q * values) @ q.T
    a = (a + a.T) / 2
    got, axes, trace = whitening.leading(a, 40)
    assert np.abs(a @ axes - axes * got).max() < 1e-14 and np.abs(axes.T @ axes - np.eye(40)).max() < 1e-14
    assert np.abs(got - np.sort(values)[::-1]).max() < 1e-13 and trace == pytest.approx(values.sum())
    start = np.linalg.eigh(a.astype(np.float32))[1]
    assert np.abs(start.T @ start - np.eye(40)).max() > 1e-8  # what was corrected
    assert whitening.leading(np.zeros((3, 3)))[0].tolist() == [0, 0, 0]


def test_whitening_odd_rows(spark, frame):
    rng = np.random.default_rng(4)
    vectors = [rng.normal(size=5).tolist() for _ in range(30)]
    rows = [(k, v, 1) for k, v in enumerate(vectors)] + [(7, vectors[7], 1), (None, vectors[0], None)]
    bad = [(90, None, 1), (91, [], 1), (92, [1.0, None, 1.0, 1.0, 1.0], 1), (93, [math.nan] * 5, 1), (94, [math.inf] * 5, 1)]
    other = [(95, [1.0, 2.0], 1), (96, [1.0, 2.0], 1), (97, [1e300, 1.0, 1.0], 1)]
    table = frame(rows + bad + other, "vec_id long, embedding array<double>, dim int")
    got = whitening.whiten(table).collect()
    white, explained, _ = plain_whitening(vectors + [vectors[7], vectors[0]], 5)
    fives = [r for r in got if r["n"] == 32]
    assert len(fives) == 160 and {r["component"] for r in fives} == {1, 2, 3, 4, 5} and {r["vec_id"] for r in fives} == {None, *range(30)}
    first = {r["vec_id"]: r["whitened"] for r in fives if r["component"] == 1}
    assert abs(abs(first[3]) - abs(white[3, 0])) < 1e-9 and all(r["identity_error"] < 1e-9 for r in fives)
    flat = [r for r in got if r["vec_id"] in (95, 96, 97)]
    assert sorted((r["vec_id"], r["component"], r["deviation"], r["whitened"], r["explained"], r["identity_error"]) for r in flat) == [
        (v, c, 0, None, None, None) for v, k in ((95, 2), (96, 2), (97, 3)) for c in range(1, k + 1)
    ]
    assert whitening.whiten(table.limit(0)).count() == 0


def plain_alignment():
    """text -> (n_a, n_b, n_groups, pairs of ids that end together, groups)"""
    a = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    spelled = alignment._byte_spelling()

    def run(text):
        if not text:
            return 0, 0, 0, [], ""
        want = f" {text}".encode()
        ids = a.encode(f" {text}", add_special_tokens=False).ids, b.encode(text)
        raw_a = [bytes(spelled[c] for c in a.id_to_token(i)) for i in ids[0]]
        raw_b = [bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode() for i in ids[1]]
        if b"".join(raw_a) != want or b"".join(raw_b) != want:
            return 0, 0, 0, [], ""
        ends = [np.cumsum([len(x) for x in raw]).tolist() for raw in (raw_a, raw_b)]
        at = dict(zip(ends[1], ids[1]))
        pairs = [(i, at[e]) for i, e in zip(ids[0], ends[0]) if e in at]
        groups, low = [], 0
        for e in sorted(set(ends[0]) & set(ends[1])):
            both = [",".join(str(i) for i, x in zip(ids[k], ends[k]) if low < x <= e) for k in (0, 1)]
            groups.append("|".join(both))
            low = e
        return len(ids[0]), len(ids[1]), len(groups), pairs, ";".join(groups)

    return run


ALPHABET = list("aab  \n\t'sdé漢ß1203.,!<|▁ ́ x🙂\x1f\x00 　") + ["the", "ing", " the", "<|endoftext|>", "</s>", "   ", "'re", "end.\nÉt", "<0x0A>", "<unk>", "\n\n"]


def test_alignment_against_the_libraries():
    pick, plain = random.Random(5), plain_alignment()
    texts = ["".join(pick.choices(ALPHABET, k=pick.randint(0, 30))) for _ in range(1500)] + ["", "a\nb\nc\n\nd", "one two one"]
    aligner = alignment.Aligner(public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"), limit=400)
    for k in range(0, len(texts), 250):
        part = texts[k : k + 250]
        facts, keys, links, groups = aligner.align(pa.array(part, pa.large_string()))
        at = np.concatenate(([0], np.cumsum(links)))
        for n, text in enumerate(part):
            own = [(int(p) >> 32, int(p) & 0xFFFFFFFF) for p in keys[at[n] : at[n + 1]]]
            assert (*facts[n].tolist(), own, "".join(groups[n])[:-1]) == plain(text), repr(text)


def test_links_of_each_kind():
    """Random cuts of the same bytes, all pairs of tokens looked at."""
    rng = np.random.default_rng(1)
    for _ in range(30):
        size = int(rng.integers(1, 40))
        a, b = (np.append(np.sort(rng.choice(size - 1, rng.integers(0, size), replace=False)) + 1 if size > 1 else [], size).astype(int) for _ in "ab")
        a, b = np.unique(a), np.unique(b)
        starts = [np.concatenate(([0], e[:-1])) for e in (a, b)]
        common = sorted(set(a.tolist()) & set(b.tolist()))
        group = [[sum(c < x for c in common) for x in e.tolist()] for e in (a, b)]
        every = [(i, j) for i in range(len(a)) for j in range(len(b))]
        want = {
            "overlap": [(i, j) for i, j in every if max(starts[0][i], starts[1][j]) < min(a[i], b[j])],
            "end": [(i, j) for i, j in every if a[i] == b[j]],
            "group": [(i, j) for i, j in every if group[0][i] == group[1][j]],
        }
        for kind, pairs in want.items():
            i, j, of_a, of_b = alignment.link_tokens(a, b, kind)
            assert list(zip(i.tolist(), j.tolist())) == pairs and [of_a.tolist(), of_b.tolist()] == group
    with pytest.raises(ValueError):
        alignment.link_tokens(a, b, "near")


def test_csr_products():
    rng = np.random.default_rng(2)
    a, b = (rng.integers(0, 3, s) * rng.integers(0, 2, s) for s in ((6, 9), (9, 4)))

    def sparse(m):
        rows, cols = np.nonzero(m)
        return alignment.Csr(np.concatenate(([0], np.cumsum(np.bincount(rows, minlength=len(m))))), cols, m[rows, cols], m.shape[1])

    def dense(m):
        out = np.zeros((len(m.ptr) - 1, m.n_cols), int)
        i, j, v = m.entries()
        out[i, j] = v
        return out

    assert (dense(sparse(a).times(sparse(b))) == a @ b).all() and (dense(sparse(a).transpose()) == a.T).all()


def whole_counts(texts):
    plain = plain_alignment()
    each = [plain(t) for t in texts]
    counts = Counter(p for r in each for p in r[3])
    best = {}
    for (_, b), n in counts.items():
        best[b] = max(best.get(b, 0), n)
    return [
        (r[0], r[1], r[2], len(r[3]), sum(counts[p] == best[p[1]] for p in r[3]), sum(counts[p] for p in r[3]), r[4]) for r in each
    ]


@pytest.mark.parametrize("hot", [200_000, 30])
def test_op13_of_the_table(spark, monkeypatch, hot):
    """With few hot pairs most links are joined by pair."""
    monkeypatch.setattr(alignment, "HOT_PAIRS", hot)
    table = spark.read.parquet(f"{SF}/documents.parquet").orderBy("doc_id").collect()
    want = {d["doc_id"]: r for d, r in zip(table, whole_counts([d["text"] for d in table]))}
    for r in queries.op13_alignment(spark, SF).collect():
        *numbers, groups = want[r["doc_id"]]
        assert [r["n_a"], r["n_b"], r["n_groups"], r["n_links"], r["n_best"], r["count_sum"]] == numbers
        assert r["groups_sha256"] == (hashlib.sha256(groups.encode()).hexdigest() if groups else "")


def test_alignment_odd_rows(odd_docs):
    paths = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
    rows = alignment.score_links(alignment.align(odd_docs, *paths)).collect()
    assert len(rows) == 8 and {r["doc_id"] for r in rows} == {None, 0, 1, 2, 3, 4, 5}
    assert all((r["n_a"], r["n_b"], r["n_groups"], r["n_best"], r["count_sum"], r["groups"]) == (0, 0, 0, 0, 0, "") for r in rows if r["doc_id"] in (1, 2))
    assert all(r["n_links"] == r["n_groups"] > 0 for r in rows if r["doc_id"] not in (1, 2))
    assert alignment.score_links(alignment.align(odd_docs.limit(0), *paths)).count() == 0
