"""Top-k search, n-gram join, line dedup, components, and the pipeline."""

import math
import random

import numpy as np

import corpus_pipeline
from sparkmart.llm import line_dedup, linking, ngram_join, oracles, queries, top_products
from tests.conftest import SF
from tests.oracle import compare


class Named:
    def __init__(self, name):
        self.name, self.sql = name, queries.oracle_sql()[name]

    def run(self, spark, folder):
        return queries.queries()[self.name](spark, folder)


def test_queries_against_sql(spark):
    for name in queries.oracle_sql():
        assert compare(spark, SF, Named(name)) == [], name


def test_top_products_brute_force(frame):
    rng = np.random.default_rng(1)
    vectors = [rng.normal(size=6) * rng.choice([0.1, 1, 4]) for _ in range(120)] + [np.ones(6)] * 40
    rows = [(k, [float(x) for x in v], 1) for k, v in enumerate(vectors)]
    rows += [(200, None, 1), (201, [1.0, None], 1), (202, [math.nan] * 6, 1), (203, [math.inf] * 6, 1), (None, [1.0] * 6, 1), (204, [], 1)]
    table = frame(rows, "vec_id long, embedding array<double>, score int")
    whole = {k: np.floor(64 * v).astype(int) for k, v in enumerate(vectors)}
    got = {}
    for r in top_products.top_products(table).collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    assert sorted(got) == list(range(0, 160, 20))
    for q, found in got.items():
        best = sorted(((-int(whole[q] @ v), k) for k, v in whole.items() if k != q))[:20]
        assert sorted(found) == [(n + 1, k, -s) for n, (s, k) in enumerate(best)]
    assert top_products.top_products(table.limit(0)).count() == 0


def test_top_products_moves_little(frame, monkeypatch):
    """No side with vectors is broadcast, as a query block goes to many blocks, and short blocks get no vectors at all."""
    rng = np.random.default_rng(2)
    rows = [(k, [float(x) for x in rng.normal(size=6) * 0.97**k]) for k in range(200)]
    monkeypatch.setattr(top_products, "BLOCK", 16)
    monkeypatch.setattr(top_products, "QUERIES", 4)
    kept = []
    if hasattr(top_products, "reachable"):
        whole = top_products.reachable
        monkeypatch.setattr(top_products, "reachable", lambda q, b: kept.append((whole(q, b), q.count() * b.count())) or kept[0][0])
    found = top_products.top_products(frame(rows, "vec_id long, embedding array<double>"), k=3)
    plan = found._jdf.queryExecution().sparkPlan().toString()
    assert "BroadcastHashJoin" not in plan and plan.count("SortMergeJoin") == 2
    assert kept[0][0].count() < 0.7 * kept[0][1]
    vectors = {k: np.floor(64 * np.array(v)).astype(int) for k, v in rows}
    for q, rank, vec_id, score in found.collect():
        best = sorted(((-int(vectors[q] @ v), k) for k, v in vectors.items() if k != q))
        assert best[rank - 1] == (-score, vec_id)


def test_components(frame):
    pick = random.Random(3)
    edges = [(pick.randrange(60), pick.randrange(60)) for _ in range(45)] + [(k, k + 1) for k in range(100, 140)] + [(300, k) for k in range(301, 360)]
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a != b:
            x, y = sorted((find(a), find(b)))
            parent[y] = x
    got = {r["node"]: r["root"] for r in linking.components(frame(edges, "a long, b long")).collect()}
    assert got == {x: find(x) for x in parent}
    assert linking.components(frame([], "a long, b long")).count() == 0


def test_pairs_of_one_group_are_not_tried_again(frame):
    """Nodes that the first round has tied together in one bucket do not meet as centres of another."""
    rows = [(1, k) for k in range(1, 22)] + [(2, k) for k in range(2, 21)]
    buckets = frame([(b, k, 0, 1, 0) for b, k in rows], "bucket long, node long, pos long, size long, part int")
    tried = []

    def verify(pairs):
        tried.append({(r["a"], r["b"]) for r in pairs.collect()})
        return pairs.filter("a > 1 AND b < 21")

    _, roots = linking.link_in_buckets(buckets, "bucket", verify)
    assert {r["node"]: r["root"] for r in roots.collect()} == {k: 2 for k in range(2, 21)}
    assert tried[1] and all(b == 21 for _, b in tried[1])  # with 8 centres for each of 20 nodes before


def near_copies(n, edits, seed):
    """Variants of one text, each with some words replaced: linked only in part."""
    pick = random.Random(seed)
    base = [f"w{pick.randrange(10_000)}" for _ in range(120)]
    out = []
    for k in range(n):
        words = list(base)
        for _ in range(pick.randrange(edits + 1)):
            words[pick.randrange(120)] = f"x{k}{pick.randrange(99)}"
        out.append(" ".join(words))
    return out


def brute_components(texts, n, percent):
    def shingles(text):
        words = (text or "").split()
        return {" ".join(words[k : k + n]) for k in range(len(words) - n + 1)} if len(words) >= n else ({" ".join(words)} if words else set())

    sets = [shingles(t) for t in texts]
    root = list(range(len(texts)))
    for a in range(len(texts)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if both and 100 * both >= percent * len(sets[a] | sets[b]) and root[a] != root[b]:
                low, high = sorted((root[a], root[b]))
                root = [low if r == high else r for r in root]
    return [(k, len(sets[k]), root[k]) for k in range(len(texts))]


def test_ngram_join_in_dense_groups(docs):
    texts = near_copies(60, 9, 1) + near_copies(25, 3, 2) + ["one two", "one two", "ONE two", "", None, "three"] * 2
    lowered = [t.lower() if t else t for t in texts]
    got = sorted(tuple(r) for r in ngram_join.component_table(docs(texts)).collect())
    assert got == brute_components(lowered, 4, 85)


def test_ngram_join_with_split_buckets(docs, monkeypatch):
    """Buckets that are split by node lose no link."""
    monkeypatch.setattr(ngram_join, "HOT_ROWS", 3)
    passage = " ".join(f"p{i}" for i in range(60))
    texts = near_copies(50, 9, 3) + [f"{passage} q{k} q{k + 1} q{k // 2}" for k in range(40)] + [passage] * 4
    got = sorted(tuple(r) for r in ngram_join.component_table(docs(texts)).collect())
    assert got == brute_components(texts, 4, 85)


def test_ngram_join_moves_sets_of_close_pairs_only(docs, monkeypatch):
    """Texts that share a rare passage and little else are settled by their sketches; those near the bound are not lost."""
    moved, write = [], ngram_join.durable
    monkeypatch.setattr(ngram_join, "durable", lambda df, label="table": moved.append((label, write(df, label))) or moved[-1][1])
    passage = " ".join(f"p{i}" for i in range(30))
    texts = [f"{passage} " + " ".join(f"q{k}x{i}" for i in range(90 + k % 9)) for k in range(40)] + near_copies(40, 9, 5)
    got = sorted(tuple(r) for r in ngram_join.component_table(docs(texts)).collect())
    assert got == brute_components(texts, 4, 85)
    assert sum(df.count() for label, df in moved if label == "wanted") <= 150  # all 80 at least twice without sketches


def test_sketches_never_say_more_than_the_sets(frame):
    rng = np.random.default_rng(4)
    rows, apart = [], []
    for k in range(200):
        n = int(rng.integers(1, 700))
        one = rng.integers(0, 1 << 63, n, dtype=np.uint64)
        two = np.concatenate((one[: int(rng.integers(0, n + 1))], rng.integers(0, 1 << 63, int(rng.integers(1, 400)), dtype=np.uint64)))
        apart.append(len(np.setxor1d(one, two)))
        rows.append((k, ngram_join.sketch(one).tolist(), ngram_join.sketch(two).tolist()))
    table = frame(rows, "k int, x array<long>, y array<long>")
    got = {r[0]: r[1] for r in table.select("k", ngram_join.fewest_apart(table.x, table.y)).collect()}
    assert all(0 <= got[k] <= n for k, n in enumerate(apart)) and sum(got[k] > 0 for k in got) > 100


def test_ngram_join_odd_rows(odd_docs):
    got = ngram_join.component_table(odd_docs).collect()
    assert len(got) == 8 and all(r["component_id"] == r["doc_id"] for r in got)
    assert ngram_join.component_table(odd_docs.limit(0)).count() == 0
    kept = ngram_join.keep_one(odd_docs)
    assert kept.columns == odd_docs.columns and kept.count() == 7


def test_lines_kept_once(docs):
    long = " ".join(f"passage{k} runs" for k in range(30))
    near = long.replace("passage7 ", "passages7 ")
    texts = [f"first line of the first text\n{long}\nok", f"{near}\nanother line that is here alone", f"short\nshort\n{long.upper()}!", None, "", long]
    rows = {r["doc_id"]: r for r in line_dedup.dedup_lines(docs(texts)).collect()}
    assert rows[0]["text"] == texts[0] and rows[1]["text"] == "another line that is here alone"
    assert rows[2]["text"] == "short\nshort" and rows[5]["text"] == ""
    assert (rows[3]["text"], rows[4]["text"]) == (None, "") and [rows[k]["n_dropped"] for k in range(6)] == [0, 1, 1, 0, 0, 1]


def test_line_dedup_odd_rows(odd_docs):
    got = line_dedup.dedup_lines(odd_docs)
    assert got.columns == [*odd_docs.columns, "n_dropped"] and got.count() == 8
    rows = got.collect()
    assert next(r["text"] for r in rows if r["doc_id"] == 0).count("cat") == 1
    assert line_dedup.dedup_lines(odd_docs.limit(0)).count() == 0


def test_lines_of_a_real_table(spark):
    """No normalised line of five words or more is left twice; other lines stay."""
    seen = set()
    before = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    for r in sorted(queries.op10_line_dedup(spark, SF).collect(), key=lambda r: r["doc_id"]):
        lines = r["text"].split("\n")
        for line in lines:
            norm = " ".join("".join(c if c.isalnum() else " " for c in line.lower()).split())
            if len(norm.split()) >= 5:
                assert norm not in seen
                seen.add(norm)
        rest = iter(before[r["doc_id"]].split("\n"))
        assert not r["text"] or all(line in rest for line in lines)  # in order


def test_pipeline_stages(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, count = docs.columns, docs.count()
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, SF).write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        if name != "packing":
            assert docs.columns == columns and 0 < docs.count() <= count
            count = docs.count()
    assert docs.select("doc_id").distinct().count() == count
    assert oracles.ngrams(5, 80)


def edit_distance(a, b):
    """Levenshtein distance, bit-parallel."""
    if not a:
        return len(b)
    mask, top, places = (1 << len(a)) - 1, 1 << (len(a) - 1), {}
    for k, c in enumerate(a):
        places[c] = places.get(c, 0) | 1 << k
    more, less, score = mask, 0, len(a)
    for c in b:
        eq = places.get(c, 0)
        xv, xh = eq | less, (((eq & more) + more) ^ more) | eq
        up, down = less | ~(xh | more) & mask, more & xh
        score += bool(up & top) - bool(down & top)
        up, down = (up << 1 | 1) & mask, (down << 1) & mask
        more, less = down | ~(xv | up) & mask, up & xv
    return score


def brute_lines(texts, min_words=5, percent=20):
    """Texts without repeated lines, all pairs of lines compared."""
    lines = [(d, p, " ".join("".join(c if c.isalnum() else " " for c in line.lower()).split())) for d, t in enumerate(texts) for p, line in enumerate(t.split("\n"))]
    lines = [x for x in lines if len(x[2].split()) >= min_words]
    root = list(range(len(lines)))
    for a, (_, _, x) in enumerate(lines):
        for b, (_, _, y) in enumerate(lines[:a]):
            room = max(len(x), len(y)) * percent // 100
            if root[a] != root[b] and abs(len(x) - len(y)) <= room and edit_distance(x, y) <= room:
                low, high = sorted((root[a], root[b]))
                root = [low if r == high else r for r in root]
    gone = {lines[k][:2] for k in range(len(lines)) if root[k] != k}
    return ["\n".join(line for p, line in enumerate(t.split("\n")) if (d, p) not in gone) for d, t in enumerate(texts)]


def edited(pick, line, edits):
    """The line with letters replaced in so many distinct words."""
    words = line.split()
    for k in pick.sample(range(len(words)), min(edits, len(words))):
        at = pick.randrange(len(words[k]))
        words[k] = words[k][:at] + pick.choice("qxzj") + words[k][at + 1 :]
    return " ".join(words)


def test_near_lines_against_brute_force(docs):
    """Lines of 5 to 100 words with 1 to 5 edits, and with an edit in every word, each beside lines of its own vocabulary."""
    pick = random.Random(8)
    vocabulary = ["".join(pick.choice("abcdefghilmnoprstu") for _ in range(pick.randrange(3, 10))) for _ in range(300)]
    texts = []
    for n in (5, 7, 12, 20, 30, 50, 100):
        for edits in (1, 2, 3, 4, 5, n):
            line = " ".join(pick.choice(vocabulary) for _ in range(n))
            texts += [f"{line}\nshort one", edited(pick, line, edits)]
    got = {r["doc_id"]: r["text"] for r in line_dedup.dedup_lines(docs(texts)).collect()}
    want = brute_lines(texts)
    assert [got[k] for k in range(len(texts))] == want and want.count("") > 30


def test_lines_edited_at_both_ends(docs):
    """A template with another number in front and another name behind, and five words with the middle one edited."""
    middle = " ".join(f"part{k} of the notice" for k in range(12))
    texts = [f"1201 {middle} signed miller", f"1377 {middle} signed walter", "seven brown horses running home", "seven brown horzes running home"]
    got = {r["doc_id"]: r["text"] for r in line_dedup.dedup_lines(docs(texts)).collect()}
    assert [got[k] for k in range(4)] == [texts[0], "", texts[2], ""]


def test_keep_one_with_repeated_and_null_ids(frame):
    """One id with a copy and a text of its own, and copies without id."""
    a, b, c = (" ".join(f"{x}{k}" for k in range(30)) for x in "abc")
    rows = [(1, a), (2, a), (2, b), (None, c), (None, c), (3, ""), (3, None)]
    got = [tuple(r) for r in ngram_join.keep_one(frame(rows, "doc_id long, text string")).collect()]
    assert sorted(got, key=str) == sorted([(1, a), (2, b), (None, c), (3, ""), (3, None)], key=str)


def test_keep_one_against_brute_force(docs):
    """The n-gram stage of the pipeline: shingles of five words at 0.8."""
    texts = near_copies(40, 9, 3) + near_copies(20, 3, 4) + ["one two", "one two", "", None]
    got = sorted(r["doc_id"] for r in ngram_join.keep_one(docs(texts), n=5, percent=80).collect())
    assert got == [k for k, _, root in brute_components(texts, 5, 80) if k == root]


def test_recall_of_blocks(spark, docs):
    """Without the exact search: planted lines of 5 to 100 words with 1 to 5 edits, and the lines of a real table."""
    pick = random.Random(9)
    vocabulary = ["".join(pick.choice("abcdefghilmnoprstu") for _ in range(pick.randrange(3, 10))) for _ in range(2000)]
    texts = []
    for n in (5, 7, 9, 12, 15, 20, 30, 50, 100):
        for edits in (1, 2, 3, 4, 5):
            for _ in range(4):
                line = " ".join(pick.choice(vocabulary) for _ in range(n))
                near = edited(pick, line, edits)
                if edit_distance(line, near) * 5 <= len(line):
                    texts += [line, near]
    got = {r["doc_id"]: r["text"] for r in line_dedup.dedup_lines(docs(texts), exact=False).collect()}
    found = [got[k] == "" for k in range(1, len(texts), 2)]
    assert all(got[k] == texts[k] for k in range(0, len(texts), 2)) and sum(found) >= 0.9 * len(found)
    table = spark.read.parquet(f"{SF}/documents.parquet")
    dropped = [line_dedup.dedup_lines(table, exact=e).agg({"n_dropped": "sum"}).first()[0] for e in (True, False)]
    assert dropped[0] * 0.9 <= dropped[1] <= dropped[0]


def test_line_dedup_with_taken_names_and_repeated_ids(frame):
    line = "one line of seven words in all"
    rows = [(1, "x\n" + line, 5, "a"), (1, line, 6, "b"), (None, line, 7, "c"), (2, "y", 8, None)]
    got = line_dedup.dedup_lines(frame(rows, "doc_id long, text string, n_dropped int, gone string"), exact=False)
    assert got.columns == ["doc_id", "text", "n_dropped", "gone", "n_dropped_"]
    kept = sorted(((r["text"], r["n_dropped"], r["gone"], r["n_dropped_"]) for r in got.collect()), key=str)
    assert sum(line in k[0] for k in kept) == 1 and sum(k[3] for k in kept) == 2 and sorted(k[1] for k in kept) == [5, 6, 7, 8]




def test_bounds_of_close_texts_agree_with_the_distance(frame):
    """Texts with letters and words edited, moved, dropped and added, up to and just over the room, and texts that repeat themselves."""
    pick = random.Random(12)
    vocabulary = ["".join(pick.choice("abcdeäßé") for _ in range(pick.randrange(2, 9))) for _ in range(60)]
    rows = [("", "", 0), ("", "a", 0), ("", "a", 1), ("ab", "ba", 1), ("aa " * 50, "aa " * 48, 6), ("aa " * 50, "aa " * 48, 5)]
    for n in (3, 8, 20, 60, 120):
        for edits in range(0, n, max(1, n // 12)):
            x = [pick.choice(vocabulary) for _ in range(n)]
            y = list(x)
            for _ in range(edits):
                at, kind = pick.randrange(len(y)), pick.randrange(4)
                new = [[], [y[at], pick.choice(vocabulary)], ["q" + y[at]], [pick.choice(vocabulary)]][kind]
                y = y[:at] + new + y[at + 1 :] or ["z"]
            if pick.random() < 0.2:
                y = y[3:] + y[:3]
            x, y = " ".join(x), " ".join(y)
            d = edit_distance(x, y)
            rows += [(x, y, room) for room in {d, max(d - 1, 0), max(len(x), len(y)) // 5}]
    table = frame([(k, *r) for k, r in enumerate(rows)], "a long, x string, y string, room int")
    got = {r["a"] for r in line_dedup._close(table).collect()}
    assert got == {k for k, (x, y, room) in enumerate(rows) if edit_distance(x, y) <= room} and 0 < len(got) < len(rows)
    assert line_dedup._close(table).columns == table.columns


def test_pairs_whose_only_block_is_full(docs, monkeypatch):
    """Without the exact search: pairs of near lines that share but one block, which 200 other lines share too."""
    monkeypatch.setattr(line_dedup, "_TILE", 32, raising=False)
    pick = random.Random(10)
    vocabulary = ["".join(pick.choice("abcdefghilmnoprstu") for _ in range(pick.randrange(5, 10))) for _ in range(2000)]

    def line():
        return ["notice", "of", "sale", *(pick.choice(vocabulary) for _ in range(18))]

    texts = [" ".join(line()) for _ in range(200)]
    for _ in range(20):
        words = line()
        near = [w if k < 3 or k in (9, 10, 11) else "x" + w[1:] for k, w in enumerate(words)]
        texts += [" ".join(words), " ".join(near)]
    got = {r["doc_id"]: r["text"] for r in line_dedup.dedup_lines(docs(texts), exact=False).collect()}
    assert [got[k] for k in range(len(texts))] == [t if k < 200 or k % 2 == 0 else "" for k, t in enumerate(texts)]


def edited_everywhere():
    """Lines of 5 to 20 long words, each followed by itself with a letter replaced in every word, which no two runs of words survive."""
    pick = random.Random(12)
    texts = []
    for n in (5, 6, 9, 12, 20):
        for _ in range(3):
            line = " ".join("".join(pick.choice("abcdefghilmnoprstu") for _ in range(pick.randrange(6, 11))) for _ in range(n))
            texts += [line, edited(pick, line, n)]
    return texts


def test_query_finds_lines_that_share_no_block(spark, docs, tmp_path):
    texts = edited_everywhere()
    docs(texts).write.parquet(f"{tmp_path}/documents.parquet")
    got = {r["doc_id"]: r["text"] for r in queries.op10_line_dedup(spark, str(tmp_path)).collect()}
    assert [got[k] for k in range(len(texts))] == brute_lines(texts) == [t if k % 2 == 0 else "" for k, t in enumerate(texts)]


def test_exact_search_in_many_stripes(docs, monkeypatch):
    """Lines of one length in several stripes, and pairs of unlike length across them."""
    monkeypatch.setattr(line_dedup, "_CHUNK", 12)
    monkeypatch.setattr(line_dedup, "_CHUNK_LETTERS", 1000, raising=False)
    texts = edited_everywhere()
    texts = [t for k, t in enumerate(texts) for t in ((t, f"{t} more") if k % 2 else (t, "x" + t[1:]))]
    texts += [" ".join(w[:6].ljust(6, "e") for w in t.split()[:5]) for t in texts]
    got = {r["doc_id"]: r["text"] for r in line_dedup.dedup_lines(docs(texts)).collect()}
    assert [got[k] for k in range(len(texts))] == brute_lines(texts)


def test_pipeline_finds_lines_that_share_no_block(spark, docs):
    texts = edited_everywhere()
    kept = sorted((r["doc_id"], r["text"]) for r in corpus_pipeline.drop_repeated_lines(spark, docs(texts), "").collect())
    assert kept == list(enumerate(texts))[::2]
