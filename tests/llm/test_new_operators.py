"""Periodic runs, spelling variants and nearest neighbours against plain Python."""

import random
import re
from collections import Counter, defaultdict
from hashlib import sha256
from zlib import crc32

import numpy as np
import pytest
from pyspark.sql import types as T

from wattledger.llm import catalog, neighbours, periodic_runs, spelling

from .conftest import SMALL

# --- periodic runs ------------------------------------------------------------------------------


def plain_runs(ids):
    n, out = len(ids), []
    for q in range(1, n // 3 + 1):
        i = 0
        while i < n - q:
            j = i
            while j < n - q and ids[j] == ids[j + q]:
                j += 1
            if j - i + q >= max(24, 3 * q):
                part = ids[i : j + q]
                if not any(part[d:] == part[:-d] for d in range(1, q)):
                    out.append((i, j - i + q, q))
            i = max(j, i + 1)
    return sorted(out, key=lambda r: (r[0], r[2]))


def plain_digest(doc_id, text):
    w = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode())
    h = crc32(b"" if doc_id is None else str(doc_id).encode())
    if h % 10 == 0 and w:
        g = h // 10
        a = g % len(w)
        p = 1 + (len(w) - a) // (3 + g % 8)
        w = [w[i] if i < a else w[a + (i - a) % p] for i in range(len(w))]
    number = {x: i for i, x in enumerate(dict.fromkeys(w))}
    runs = plain_runs([number[x] for x in w])
    drop = {i for s, m, p in runs for i in range(s + p, s + m)}
    best = min(runs, key=lambda r: (-r[1] / r[2], r[0], r[2])) if runs else (None,) * 3
    listed = "".join(f"{s},{m},{p}\n" for s, m, p in runs).encode()
    kept = b" ".join(x for i, x in enumerate(w) if i not in drop)
    milli = 1000 * best[1] // best[2] if runs else None
    return (doc_id, len(runs), *best, milli, sha256(listed).hexdigest(), sha256(kept).hexdigest())


def test_runs_equal_plain_search():
    random.seed(3)
    for _ in range(1500):
        n, k = random.randint(0, 150), random.choice([1, 2, 2, 3, 5, 60])
        ids = [random.randrange(k) for _ in range(n)]
        for _ in range(random.randint(0, 4)):
            if n > 30:
                a, p = random.randrange(n), random.randint(1, 40)
                unit = ids[a : a + p]
                for i in range(a, min(n, a + random.randint(1, n))):
                    ids[i] = unit[(i - a) % len(unit)]
        assert periodic_runs.find_runs(np.array(ids, np.int64)) == plain_runs(ids)


@pytest.mark.parametrize("period", [1, 2, 7, 8, 15, 16, 977, 33_333])
def test_one_long_run(period):
    ids = np.arange(100_000) % period
    assert periodic_runs.find_runs(ids) == [(0, 100_000, period)]


def test_run_limits():
    run = lambda p, n: periodic_runs.find_runs(np.concatenate([[-1], np.arange(n) % p, [-2]]))
    assert run(8, 24) == [(1, 24, 8)] and run(8, 23) == []
    assert run(9, 27) == [(1, 27, 9)] and run(9, 26) == []


def test_op11(spark, tables):
    got = {tuple(r) for r in catalog.op11_periodic_runs(spark, SMALL).collect()}
    short = {r for r in tables["documents"].select("doc_id", "text").collect() if len((r[1] or "").split()) < 800}
    assert len(got) == tables["documents"].count() and len(short) > 50
    assert {plain_digest(*r) for r in short} <= got


def test_run_digest_of_odd_rows(odd, nothing, odd_rows):
    got = Counter(tuple(r) for r in periodic_runs.run_digest(odd).collect())
    small = [r for r in odd_rows if len((r[1] or "").split()) < 5000]
    for row in small:
        assert got[plain_digest(row[0], row[1])]
    assert sum(got.values()) == len(odd_rows)
    assert periodic_runs.run_digest(nothing).count() == 0
    assert periodic_runs.run_digest(nothing).columns == ["doc_id", *periodic_runs.DIGEST.fieldNames()]


def test_collapse_keeps_rows_and_columns(odd, nothing, odd_rows):
    back = periodic_runs.collapse_runs(odd)
    assert back.columns == odd.columns and back.count() == len(odd_rows)
    texts = {r["doc_id"]: r["text"] for r in back.where("doc_id > 3").collect()}
    assert texts[7] == "the quick brown fox." and texts[5] == "\n\n" and texts[9] == "x" * 100_000
    assert periodic_runs.collapse_runs(nothing).count() == 0
    found = {r[0]: r[1] for r in odd.where("doc_id IN (2, 7)").select("doc_id", periodic_runs.periodic_runs("text")).collect()}
    assert found[2] == [] and [tuple(r) for r in found[7]] == [(0, 60_000, 4)]


# --- spelling variants --------------------------------------------------------------------------


def plain_variants(rows):
    counts = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            counts[run[: h % len(run)] + run[h % len(run) + 1 :] if h % 31 == 0 else run] += 1
    n = {w: c for w, c in counts.items() if len(w) >= 7 and c >= 2}
    near, holes = defaultdict(set), defaultdict(set)
    for w in n:
        for i in range(len(w)):
            holes[w[:i], w[i + 1 :]].add(w)
            less = w[:i] + w[i + 1 :]
            if less in n:
                near[w].add(less)
                near[less].add(w)
    for group in holes.values():
        for a in group:
            near[a] |= group - {a}
    form = {}
    for w in n:
        if near[w]:
            f = min(near[w], key=lambda x: (-n[x], x))
            if n[f] >= 10 * n[w]:
                form[w] = f
    out = set()
    for w in n:
        root = w
        while root in form:
            root = form[root]
        out.add((w, form.get(w), root, n[w], len(near[w]), n.get(form.get(w))))
    return out


def test_op12(spark, tables):
    got = [tuple(r) for r in catalog.op12_spelling_variants(spark, SMALL).collect()]
    want = plain_variants([tuple(r) for r in tables["documents"].select("doc_id", "text").collect()])
    assert len(got) == len(want) and set(got) == want
    assert any(r[1] for r in want)


@pytest.mark.parametrize("frequent", [1, 3, 50])
def test_edits_everywhere(spark, frequent):
    """Every edit of a few words, with repeated grams and letters beyond ASCII, and long chains."""
    words = {}
    for base, n in (("abababab", 5000), ("répétération", 7000), ("aaaaaaaaa", 90)):
        words[base] = n
        for i in range(len(base) + 1):
            for other in (base[:i] + "z" + base[i:], base[:i] + base[i + 1 :], base[:i] + "z" + base[i + 1 :]):
                words.setdefault(other, 3 + i)
    words |= {"chainaaa": 2, "chainaab": 25, "chainabb": 260, "chainbbb": 2700}
    table = spark.createDataFrame(list(words.items()), "word string, n long")
    got = {tuple(r) for r in spelling.variants(table, frequent).collect()}
    # Ids without noise, and each word as often as it is there.
    quiet = {w: next(i for i in range(99) if crc32(f"{i}:{w}".encode()) % 31) for w in words}
    want = plain_variants([(quiet[w], " ".join([w] * n)) for w, n in words.items()])
    assert got == {r for r in want if r[0] in words}
    assert ("chainaaa", "chainaab", "chainbbb", 2, 1, 25) in got


def test_words_of_odd_rows(spark, odd, nothing, odd_rows):
    got = {tuple(r) for r in spelling.spelling_variants(odd).collect()}
    assert got == plain_variants([r[:2] for r in odd_rows])
    assert spelling.spelling_variants(nothing).count() == 0


def test_normalised(spark):
    docs = spark.createDataFrame([(1, "Colouur colouur fine"), (None, None)], "doc_id long, text string")
    forms = spark.createDataFrame([("colouur", "colour"), ("colour", "colour")], "word string, root string")
    assert [tuple(r) for r in spelling.normalised(docs, forms).collect()] == [(1, "colouur", "colour", 2)]


# --- nearest neighbours -------------------------------------------------------------------------


def plain_nearest(rows, step, most):
    ids, x = np.array([i for i, _ in rows]), np.array([v for _, v in rows], "f8")
    out = {}
    for i in np.flatnonzero(ids % step == 0):
        score = (x * x[i]).sum(axis=1)
        others = np.flatnonzero(ids != ids[i])
        best = others[np.lexsort((ids[others], -score[others]))][:most]
        out[int(ids[i])] = [(int(ids[j]), float(score[j])) for j in best]
    return out


def by_query(frame):
    found = defaultdict(list)
    for r in sorted(frame.collect(), key=lambda r: (r["query_id"], r["rank"])):
        found[r["query_id"]].append((r["vec_id"], r["score"]))
        assert r["rank"] == len(found[r["query_id"]])
    return found


def recall(found, want):
    hits = sum(len({v for v, _ in found[q]} & {v for v, _ in best}) for q, best in want.items())
    return hits / sum(map(len, want.values()))


def test_op13(spark):
    vectors = spark.read.parquet(f"{SMALL}/embeddings.parquet")
    rows = [(r["vec_id"], r["embedding"]) for r in vectors.collect()]
    found, want = by_query(catalog.op13_neighbours(spark, SMALL)), plain_nearest(rows, 20, 20)
    assert found.keys() == want.keys() and all(len(found[q]) == 20 for q in want)
    assert recall(found, want) >= 0.9
    exact = {q: {i: s for i, s in plain_nearest(rows, 20, len(rows))[q]} for q in list(want)[:5]}
    for q, scores in exact.items():
        assert all(scores[v] == pytest.approx(s, abs=1e-12) for v, s in found[q])
        assert found[q] == sorted(found[q], key=lambda p: (-p[1], p[0]))


def test_every_code_within_the_radius_is_found():
    random_ = np.random.default_rng(5)
    codes = random_.integers(0, 256, (3000, 16)).astype(np.uint8)
    codes[1000:2000] = codes[0]
    codes[1000:2000, :3] ^= random_.integers(0, 256, (1000, 3)).astype(np.uint8)
    for radius in (0, 3, 15, 16, 40, 60, 128):
        index = neighbours.Index(codes, radius)
        for probe in codes[:3]:
            far = np.bitwise_count(codes ^ probe).sum(axis=1)
            assert np.array_equal(index.within(probe), np.flatnonzero(far <= radius))
        assert sum(neighbours.allowances(radius, 16)) == radius - 15


@pytest.mark.parametrize("size", [3, 64, 200])
def test_uneven_norms_and_blocks(spark, size):
    random_ = np.random.default_rng(size)
    middles = random_.normal(size=(20, size))
    x = middles[random_.integers(0, 20, 700)] + 0.3 * random_.normal(size=(700, size))
    x *= random_.uniform(0.2, 5, (700, 1))
    x[300:340] = x[0]
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    want = plain_nearest(rows, 20, 20)
    found = by_query(neighbours.nearest(frame, code_rows=150, query_rows=10))
    assert found.keys() == want.keys() and all(len(v) == 20 for v in found.values())
    assert recall(found, want) >= 0.9
    assert found[0] == want[0]


def test_fewer_candidates_than_wanted_and_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, [1.0, 0.0], "x"), (0, [1.0, 0.0], "x"), (20, [0.0, 2.0], "x"), (3, [1.0, 1.0], "x"), (4, [1.0, 1.0], None),
        (40, None, "x"), (5, [0.0, 0.0], "x"), (6, [nan, 1.0], "x"), (7, [inf, 1.0], "x"), (8, [None, 1.0], "x"),
        (None, [1.0, 1.0], "x"), (9, [], "x"), (60, [1.0, 2.0, 3.0], "x"),
    ]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>, rank string")
    got = [tuple(r) for r in neighbours.nearest(frame).orderBy("query_id", "rank").collect()]
    assert got == [
        (0, 1, 3, 1.0), (0, 2, 4, 1.0), (0, 3, 20, 0.0), (20, 1, 3, 2.0), (20, 2, 4, 2.0), (20, 3, 0, 0.0),
    ]
    empty = neighbours.nearest(frame.where("false"))
    assert empty.count() == 0 and empty.schema["rank"].dataType == T.IntegerType()
    alone = neighbours.nearest(frame.where("vec_id = 20"))
    assert alone.count() == 0
