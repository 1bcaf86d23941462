"""Centroids, neighbours and the filter audit against brute-force versions, and on odd and empty tables."""

import hashlib
import itertools
import math
import re

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from __spark_entry__ import oracle_sql, queries
from tests.llm.conftest import FOLDER
from tidemill.llm import centroids, filter_audit, neighbours
from verify import compare


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in ("documents", "embeddings", "labels"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{FOLDER}/{name}.parquet'")
    return con


@pytest.mark.parametrize("name", ["op11_centroids", "op13_filter_audit"])
def test_query_against_sql(spark, duck, name):
    result = compare(queries()[name](spark, FOLDER), duck, oracle_sql()[name])
    assert result.startswith("ok") and "types" not in result, result


def brute_clusters(rows, k, rounds, width):
    kept = [(i, [math.floor(256 * x) for x in v]) for i, v in rows if v is not None and len(v) == width and all(x is not None and math.isfinite(x) for x in v)]
    order = sorted(kept, key=lambda r: (hashlib.sha256(f"2:{'' if r[0] is None else r[0]}".encode()).hexdigest(), r[1]))
    seeds = [v for _, v in order[:k]]

    def assign():
        return [min((sum((a - b) ** 2 for a, b in zip(v, c)), n) for n, c in enumerate(seeds)) for _, v in kept]

    for _ in range(rounds):
        numbers = [n for _, n in assign()]
        for n in range(len(seeds)):
            own = [v for (_, v), m in zip(kept, numbers) if m == n]
            if own:
                seeds[n] = [sum(x) // len(own) for x in zip(*own)]
    found = assign()
    inertia = {n: sum(d for d, m in found if m == n) for n in range(len(seeds))}
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in seeds]
    return [(i, n, d, inertia[n], sum(inertia.values()), digest[n]) for (i, _), (d, n) in zip(kept, found)]


def spread(rows):
    return sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[1:]))


@pytest.mark.parametrize("k", [1, 3, 40])
def test_clusters_against_brute_force(spark, k):
    rng = np.random.default_rng(k)
    rows = [(int(i), [float(x) for x in rng.normal(0, 0.2, 4) + rng.integers(0, 3)]) for i in rng.integers(0, 200, 150)]
    same = [(7, [0.5, 0.25, 0.0, -0.125])] * 60
    odd = [(300, None), (301, []), (302, [1.0, None, 0.0, 0.0]), (303, [math.nan] * 4), (304, [math.inf, 0.0, 0.0, 0.0]), (305, [0.0] * 5), (306, [0.0] * 4), (None, [0.1] * 4), (307, [200000.0, 0.0, 0.0, 0.0])]
    frame = spark.createDataFrame(rows + same + odd, "vec_id long, embedding array<double>").withColumns({c: F.lit("x") for c in ("cluster", "distance", "v", "apex")})
    got = [tuple(r) for r in centroids.cluster(frame.repartition(5), k=k, rounds=3, width=4).collect()]
    assert spread(got) == spread(brute_clusters(rows + same + odd, k, 3, 4))
    assert centroids.cluster(frame.limit(0), k=k, width=4).count() == 0


def test_too_large_components_fail(spark):
    frame = spark.createDataFrame([(1, [1e30, 0.0])], "vec_id long, embedding array<double>")
    with pytest.raises(Exception, match="too large"):
        centroids.cluster(frame, width=2)


def test_bounds_hold_and_filter():
    rng = np.random.default_rng(5)
    for width, n in ((3, 200), (64, 300)):
        points = np.floor(256 * (rng.normal(0, 0.1, (n, width)) + rng.integers(0, 8, (n, 1)))).astype(np.int64)
        points[:20] = points[0]
        tops = points[np.r_[0, 30:59]]
        simplex = centroids.Simplex(tops)
        maybe = centroids.possible(simplex.apexes(points), simplex.apexes(tops))
        far = ((points[:, None, :] - tops) ** 2).sum(axis=2)
        assert all(maybe[np.arange(n), far.argmin(axis=1)]) and maybe.mean() < 0.5
        number, least = centroids.nearest(points, simplex.apexes(points), tops, simplex.apexes(tops))
        assert (number == far.argmin(axis=1)).all() and (least == far.min(axis=1)).all()
    flat = np.zeros((5, 3), dtype=np.int64)
    assert centroids.Simplex(flat).apexes(flat).shape == (5, 1)


def brute_neighbours(rows, width, every, k):
    kept = [(i, np.array(v)) for i, v in rows if v is not None and len(v) == width and all(x is not None and math.isfinite(x) for x in v) and any(v)]
    out = []
    for a, (i, v) in enumerate(kept):
        if i is not None and i % every == 0:
            far = sorted((float(np.sqrt(((w - v) ** 2).sum())), j is None, j or 0) for b, (j, w) in enumerate(kept) if b != a)[:k]
            out += [(i, n + 1, None if empty else j, d) for n, (d, empty, j) in enumerate(far)]
    return sorted(out, key=lambda r: (r[0], r[1], r[2] is None, r[2] or 0))


def test_neighbours_of_odd_rows_are_exact_on_small_tables(spark):
    """With fewer rows in a segment than are compared at least, the result is exact."""
    rng = np.random.default_rng(2)
    rows = [(int(i), [float(x) for x in rng.normal(0, 1, 4)]) for i in range(150)]
    rows += [(k, [1.0, 2.0, 3.0, 4.0]) for k in range(200, 230)] + [(20, [0.5] * 4), (20, [0.5] * 4)]
    rows += [(300, None), (310, []), (320, [1.0, None, 0.0, 0.0]), (330, [math.nan] * 4), (340, [0.0] * 4), (350, [1.0] * 5), (None, [1.0, 2.0, 3.0, 4.0])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumns({c: F.lit("x") for c in ("row", "rank", "score", "ord", "e")})
    for block in (4, 1 << 14):
        index, pivots = neighbours.build_index(frame.repartition(3), width=4, pivots=32, ordered=16)
        got = [tuple(r) for r in neighbours.search(index, pivots, F.col("vec_id") % 10 == 0, k=10, block=block).collect()]
        assert sorted(got, key=lambda r: (r[0], r[1], r[2] is None, r[2] or 0)) == brute_neighbours(rows, 4, 10, 10)
    index, pivots = neighbours.build_index(frame.limit(0), width=4)
    assert neighbours.search(index, pivots, F.col("vec_id") % 10 == 0).count() == 0
    few = neighbours.build_index(frame.filter("vec_id < 3"), width=4)
    assert neighbours.search(*few, F.col("vec_id") == 0).count() == 2


def test_footrule_from_postings():
    rng = np.random.default_rng(3)
    orders = np.stack([rng.permutation(12)[:5] for _ in range(30)]).astype(np.int16)
    posted = neighbours.postings(orders, 12)
    got = neighbours.footrules(neighbours.postings(orders[:7], 12), posted, (7, 30), 5)
    place = [{p: i for i, p in enumerate(o)} for o in orders.tolist()]
    for a, b in itertools.product(range(7), range(30)):
        assert got[a, b] == sum(abs(place[a].get(p, 5) - place[b].get(p, 5)) for p in range(12))


def test_recall_of_the_query(spark):
    folder = "/root/testdata/sf0.1"
    table = spark.read.parquet(f"{folder}/embeddings.parquet").toPandas()
    points, ids = np.stack(table["embedding"]).astype(float), table["vec_id"].to_numpy()
    found = {}
    for r in queries()["op12_neighbours"](spark, folder).collect():
        found.setdefault(r.query_id, []).append((r.score, r.vec_id))
        assert math.isclose(r.score, float(np.sqrt(((points[ids == r.vec_id][0] - points[ids == r.query_id][0]) ** 2).sum())), rel_tol=1e-12)
    hits, asked = 0, ids[ids % 100 == 0]
    assert set(found) == set(asked.tolist())
    for q in asked.tolist():
        far = np.sqrt(((points - points[ids == q][0]) ** 2).sum(axis=1))
        true = [j for _, j in sorted((d, j) for d, j in zip(far.tolist(), ids.tolist()) if j != q)[:10]]
        assert len(found[q]) == 10
        hits += len({j for _, j in found[q]} & set(true))
    assert hits / (10 * len(asked)) >= 0.95


def brute_masks(rows):
    out = []
    for doc_id, text, lang in rows:
        text = text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        smaller = any((t or "") == text and (doc_id is None and i is not None or doc_id is not None and i is not None and i < doc_id) for i, t, _ in rows)
        fails = (len(words) < 200, 100 * len(set(words)) < 50 * len(words), 100 * len(re.findall("[A-Z]", text)) > 3 * len(text), bool(re.search("[#$%&*|]", text)), smaller)
        out.append((doc_id, lang or "", sum(1 << k for k, f in enumerate(fails) if f)))
    return sorted(out, key=lambda r: (r[0] is None, r[0] or 0, r[1:]))


def brute_audit(masks, good, toxic):
    out = {}
    for part in {p for _, p, _ in masks}:
        own = [(d, m) for d, p, m in masks if p == part]
        for order in itertools.permutations("ABCDE"):
            left = own
            for step, letter in enumerate(order, 1):
                bit = 1 << "ABCDE".index(letter)
                gone = [(d, m) for d, m in left if m & bit]
                left = [(d, m) for d, m in left if not m & bit]
                out[part, "".join(order), step] = (
                    len(left), len(gone), sum(1 for _, m in own if m & bit) - len(gone), sum(1 for _, m in own if m == bit),
                    sum(d in good for d, _ in gone), sum(d in toxic for d, _ in gone),
                )
    total = {}
    for (part, order, step), row in out.items():
        total[part, order[step - 1]] = total.get((part, order[step - 1]), 0) + row[1]
    return {k: (*v, total[k[0], k[1][k[2] - 1]]) for k, v in out.items()}


def test_audit_of_odd_rows(spark, monkeypatch):
    plain = " ".join(f"w{i}" for i in range(250))
    long = " ".join(f"word{i % 977} and other{i % 31}" for i in range(60000))
    rows = [(1, None, None), (2, "", "en"), (3, " \n\t ", "en"), (4, "One", "fr"), (4, "One", "fr"), (5, long, "en"), (6, long, "de"), (None, plain, "de"), (None, plain, "de")]
    rows += [(k, plain, "en") for k in range(10, 60)] + [(k, plain + " tail", "fr") for k in (70, 71)] + [(80, plain[:400], ""), (81, "SHOUT # " * 300, "es"), (82, "naïve é\x0b" * 200, "es")]
    labels = [(4, 1, 0), (4, 0, 1), (12, 1, 0), (13, None, 1), (None, 1, 1), (81, 0, 1)]
    schema = "doc_id long, text string, lang string"
    frame = spark.createDataFrame(rows, schema).withColumns({c: F.lit("x") for c in ("mask", "part", "head", "mix", "n")})
    known = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    for run in (8 << 20, 700):
        monkeypatch.setattr(filter_audit, "RUN", run)
        masks = filter_audit.document_masks(frame.repartition(4))
        got = sorted((tuple(r) for r in masks.select("doc_id", "part", "mask").collect()), key=lambda r: (r[0] is None, r[0] or 0, r[1:]))
        assert got == brute_masks(rows)
        report = filter_audit.audit(masks, known).collect()
        want = brute_audit(got, {4, 12}, {4, 13, 81})
        assert {(r[0], r[1], r[2]): tuple(r[3:]) for r in report} == want and len(report) == 600 * 5
    assert filter_audit.audit(filter_audit.document_masks(frame.limit(0)), known).count() == 0


def test_trie_against_a_dictionary():
    rng = np.random.default_rng(4)
    texts = [bytes(rng.integers(97, 99, rng.integers(0, 9)).tolist()) for _ in range(500)]
    trie, least = filter_audit.Trie(), {}
    for doc_id, text in enumerate(texts):
        trie.insert(text, doc_id, doc_id)
        least.setdefault(text, doc_id)
    assert dict(trie) == {d: d > least[t] for d, t in enumerate(texts)}
