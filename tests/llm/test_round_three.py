"""Resharding, filter audit and whitening against plain versions, and their edge cases."""

from __future__ import annotations

import itertools
import re
import zlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from dockflow.llm import filter_audit, resharding, whitening

SCHEMA = "doc_id long, text string, lang string, source string, shard string, size string"


def docs(spark, rows):
    """Rows (doc_id, text, lang, source) beside columns with clashing names."""
    return spark.createDataFrame([(*r, "x", "y") for r in rows], SCHEMA)


# Resharding

def cheapest(supply, capacity, cost):
    @lru_cache(None)
    def best(i, room):
        if i == len(supply):
            return 0
        out = float("inf")
        for split in itertools.product(*[range(min(supply[i], r) + 1) for r in room]):
            if sum(split) == supply[i]:
                rest = best(i + 1, tuple(r - s for r, s in zip(room, split)))
                out = min(out, rest + sum(c * s for c, s in zip(cost[i], split)))
        return out
    return best(0, tuple(capacity))


def test_flow_is_the_cheapest():
    rng = np.random.default_rng(1)
    for _ in range(150):
        m, n = rng.integers(1, 4, 2)
        supply = [int(x) for x in rng.integers(0, 5, m)]
        capacity = [int(x) for x in rng.integers(0, 5, n)]
        capacity[-1] += max(0, sum(supply) - sum(capacity))
        cost = rng.integers(0, 6, (m, n))
        for table in (cost, 1 - np.eye(m, n, dtype=int)):
            flow = resharding.min_cost_flow(supply, capacity, table)
            assert [sum(r) for r in flow] == supply
            assert all(sum(c) <= k for c, k in zip(flow.T, capacity)) and (flow >= 0).all()
            assert (flow * table).sum() == cheapest(tuple(supply), tuple(capacity), tuple(map(tuple, table.tolist())))


def test_flow_refuses_what_does_not_fit():
    with pytest.raises(ValueError):
        resharding.min_cost_flow([3], [2])


def test_reshard_is_even_whole_and_moves_little(spark):
    rng = np.random.default_rng(2)
    sizes = [*rng.integers(0, 300, 3000), 40_000, 0, 0]
    rows = [(k, "é" * int(s // 2) + "a" * int(s % 2), "en", "hot" if k % 3 == 0 else f"s{k % 11}") for k, s in enumerate(sizes)]
    rows += [(None, None, None, None), (7, "twice", "en", "hot"), (7, "twice", "en", "hot")]
    got = resharding.reshard_documents(docs(spark, rows)).toPandas()
    assert len(got) == len(rows) and set(got["law"]) == {"bytes"} and got["grown_shard"].isna().all()
    want = sorted((len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for _, t, _, _ in rows)
    assert sorted(zip(got["size"], got["text_crc32"])) == want
    totals = got.groupby("shard")["size"].sum()
    assert list(totals.index) == list(range(8)) and totals.max() - totals.min() < 200
    for _, part in got.groupby("shard"):
        assert sorted(part["slot"]) == list(range(len(part)))
    old = got.groupby("old_shard")["size"].sum()
    least = sum(max(0, old[k] - sum(totals) / 8) for k in old.index)
    moved = got.loc[got["shard"] != got["old_shard"], "size"].sum()
    assert least - 1 <= moved <= least + 40_000


def test_reshard_deals_repeated_rows_one_by_one(spark):
    got = resharding.reshard_documents(docs(spark, [(1, "same text", "en", "s")] * 4000)).toPandas()
    counts = got.groupby("shard").size()
    assert len(counts) == 8 and counts.max() - counts.min() <= 1


def test_reshard_of_nothing(spark):
    assert resharding.reshard_documents(docs(spark, [])).count() == 0


def test_reshard_files_rewrites_affected_files_only(spark, tmp_path):
    root = str(tmp_path)
    rows = spark.range(4000).select(F.col("id").alias("doc_id"), F.repeat(F.lit("ab"), (F.col("id") % 50).cast("int")).alias("text"))
    resharding.write_layout(rows.repartition(24), root, F.when(F.col("doc_id") % 4 < 2, 0).otherwise(F.col("doc_id") % 4))
    before = {r["file"]: r["shard"] for r in spark.read.parquet(f"{root}/manifests/0").collect()}
    version = resharding.reshard_files(spark, root, 0, 5)
    after = {r["file"]: r["shard"] for r in spark.read.parquet(f"{root}/manifests/{version}").collect()}
    kept = set(before) & set(after)
    assert all(before[f] == after[f] for f in kept) and 0 < len(kept) < len(before)
    live = resharding.read_layout(spark, root, version)
    assert live.select("doc_id").distinct().count() == live.count() == 4000
    totals = [r[0] for r in live.groupBy("shard").agg(F.sum(F.length("text") + 1)).select("sum((length(text) + 1))").collect()]
    assert len(totals) == 5 and max(totals) - min(totals) < 500
    # Moved rows, plus the rows that stay in the one file at each cut, are all that is written.
    fresh = live.where(~F.col("file").isin(list(kept)))
    assert fresh.count() < 0.75 * 4000
    assert resharding.reshard_files(spark, root, version, 5) == version + 1


# Filter audit

def brute_audit(rows, labels):
    good = {i for i, q, _ in labels if q == 1}
    toxic = {i for i, _, t in labels if t == 1}
    failed = []
    for doc_id, text, lang, _ in rows:
        t = text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", t)
        copy = doc_id is not None and any(i is not None and i < doc_id and (o or "") == t for i, o, _, _ in rows)
        bits = [len(words) < 200, 100 * len(set(words)) < 50 * len(words), 100 * len(re.findall("[A-Z]", t)) > 3 * len(t), bool(re.search(r"[#$%&*|]", t)), copy]
        failed.append((lang or "", {c for c, b in zip("ABCDE", bits) if b}, doc_id in good, doc_id in toxic))
    out, totals = {}, {}
    for part in {f[0] for f in failed}:
        own = [f for f in failed if f[0] == part]
        for order in map("".join, itertools.permutations("ABCDE")):
            for k, c in enumerate(order):
                left = [f for f in own if not f[1] & set(order[:k])]
                gone = [f for f in left if c in f[1]]
                out[part, order, k + 1] = [
                    len(left) - len(gone), len(gone), sum(c in f[1] for f in own) - len(gone), sum(f[1] == {c} for f in own),
                    sum(f[2] for f in gone), sum(f[3] for f in gone)]
                totals[part, c] = totals.get((part, c), 0) + len(gone)
    return {k: (*v, totals[k[0], k[1][k[2] - 1]]) for k, v in out.items()}


def audited(spark, rows, labels):
    frame = spark.createDataFrame(labels, "doc_id long, quality int, toxic int, text string, lang string") if labels and len(labels[0]) == 5 else spark.createDataFrame(
        [(*x, "t", "l") for x in labels], "doc_id long, quality int, toxic int, text string, lang string")
    got = filter_audit.audit(docs(spark, rows), frame).collect()
    return {(r["part"], r["filter_order"], r["step"]): (r["kept"], r["removed"], r["redundant"], r["unique_fails"], r["good_lost"], r["toxic_lost"], r["shapley"]) for r in got}


def test_audit_equals_brute_force(spark):
    rng = np.random.default_rng(3)
    vocabulary = [f"w{k}" for k in range(400)] + ["Ünïcode", "日本語テキスト", "A" * 70 + "b", "A" * 70 + "c", "longer-than-eight", "longer-than-eighu", "x#y", "🙂"]
    rows = []
    for k in range(160):
        n, spread = int(rng.choice([0, 5, 190, 199, 200, 201, 420])), int(rng.choice([30, 408]))
        rows.append((k, str(rng.choice([" ", "\n", "\t \x0b"])).join(rng.choice(vocabulary[-spread:], n)), str(rng.choice(["en", "de"])), "s"))
    rows += [(200 + k, rows[k % 7][1], "fr", "s") for k in range(60)]
    rows += [(None, None, None, None), (None, rows[3][1], "en", "s"), (5, "", "", "s"), (900, rows[3][1], "en", "s"), (900, rows[3][1], "de", "s"), (901, "   ", "en", "s")]
    labels = [(k, k % 2, k % 3 == 0 and 1 or 0) for k in range(0, 260, 3)] + [(3, 1, 1), (6, None, None), (None, 1, 1)]
    assert audited(spark, rows, labels) == brute_audit(rows, [x for x in labels if x[0] is not None])


def test_audit_of_nothing_and_of_one_row(spark):
    assert audited(spark, [], []) == {}
    got = audited(spark, [(1, None, None, None)], [])
    assert len(got) == 600 and got["", "ABCDE", 1] == (0, 1, 0, 1, 0, 0, 120)


def test_transducer_state_crosses_slabs(monkeypatch):
    monkeypatch.setattr(filter_audit, "SLAB", 7)
    rng = np.random.default_rng(4)
    texts = ["".join(rng.choice(list("aB é\n#日 "), n)) for n in (0, 1, 6, 7, 8, 0, 50, 300)]
    found = filter_audit.measure_texts(pa.array(texts))
    for k, t in enumerate(texts):
        words = re.findall(r"[^\x20\x09-\x0D]+", t)
        assert found[:, k].tolist() == [len(words), len(set(words)), t.count("B"), len(t), t.count("#")]


def test_words_with_one_hash_are_told_apart(monkeypatch):
    monkeypatch.setattr(filter_audit.Words, "hashes", lambda self: np.zeros(len(self.starts), np.uint64))
    texts = [" ".join(f"w{k % 40}-{'z' * (k % 3 * 40)}" for k in range(300))]
    assert filter_audit.measure_texts(pa.array(texts))[1, 0] == len(set(texts[0].split()))


def test_long_text_and_long_word():
    texts = ["ab " * 1_000_000, "x" * 5_000_000, "x" * 99 + " " + "x" * 99 + " " + "x" * 98 + "y"]
    assert filter_audit.measure_texts(pa.array(texts))[:2].tolist() == [[1_000_000, 1, 3], [1, 1, 2]]


# Whitening

def vectors(spark, rows):
    return spark.createDataFrame([(k, v, "x", 1) for k, v in rows], "vec_id long, embedding array<float>, x string, n int")


def plain_whitening(rows):
    valid = [(k, [int(np.floor(64 * float(c))) + 1_000_000 for c in np.array(v, np.float32).astype(float)]) for k, v in rows]
    fit = np.array(sorted({tuple(x) for _, x in valid}))
    n, sums = len(fit), fit.sum(axis=0)
    y = fit - sums // n - (sums % n) / n
    values, basis = np.linalg.eigh(y.T @ y / n)
    return valid, n, sums, values[::-1], basis[:, ::-1]


def check_whitening(got, rows, top=16):
    valid, n, sums, values, basis = plain_whitening(rows)
    count = min(top, int((values > 1e-12 * values[0]).sum()))
    assert len(got) == count * len(valid)
    by = {}
    for r in got:
        by.setdefault(r["vec_id"], {})[r["component"]] = r
    trace = values.sum()
    for vec_id, x in valid:
        rows_of = by[vec_id]
        y = np.array(x) - sums // n - (sums % n) / n
        for c in range(count):
            r = rows_of[c + 1]
            assert r["n"] == n and r["deviation"] == sum((n * int(a) - int(s)) ** 2 for a, s in zip(x, sums))
            assert abs(r["explained"] - values[c] / trace) <= 1e-10 and r["identity_error"] < 1e-9
            want = abs(basis[:, c] @ y) / np.sqrt(values[c])
            assert abs(abs(r["whitened"]) - want) < 1e-6 * max(1, want)


def test_whitening_equals_eigh(spark):
    rng = np.random.default_rng(5)
    rows = [(k, (rng.standard_normal(24) * np.linspace(3, 0.2, 24) + 1e3).tolist()) for k in range(400)]
    rows += [(1000 + k, rows[0][1]) for k in range(300)]
    extra = [(5000, None), (5001, [None] * 24), (5002, [float("nan")] * 24), (5003, [float("inf")] * 24), (5004, [1.0] * 23), (5005, [])]
    got = whitening.whiten(vectors(spark, rows + extra)).collect()
    check_whitening(got, rows)
    signs = {(r["component"], np.sign(r["whitened"])) for r in got if r["vec_id"] in (0, 1000)}
    assert len(signs) == 16


def test_whitening_without_variance(spark):
    assert whitening.whiten(vectors(spark, [])).count() == 0
    assert whitening.whiten(vectors(spark, [(1, None), (2, [None])])).count() == 0
    assert whitening.whiten(vectors(spark, [(1, [1.0, 2.0]), (2, [1.0, 2.0])])).count() == 0
    flat = [(k, [float(k), 5.0, 2.0 * k]) for k in range(20)]
    check_whitening(whitening.whiten(vectors(spark, flat)).collect(), flat)
    assert whitening.whiten(vectors(spark, [(None, [1.0]), (1, [2.0])])).count() == 2


@pytest.mark.parametrize("values", [
    np.linspace(1, 64, 64), np.logspace(0, -9, 48), np.array([5.0] * 10 + [1.0] * 20 + [0.0] * 4), np.ones(7), np.zeros(3), np.array([2.0]),
    np.array([1e6] + [1.0] * 30), np.array([1.0] * 30 + [1 - 1e-9] * 10),
])
def test_components_equal_the_spectrum(values):
    rng = np.random.default_rng(6)
    q, _ = np.linalg.qr(rng.standard_normal((len(values), len(values))))
    a = q @ np.diag(values) @ q.T
    a = (a + a.T) / 2
    got, basis = whitening.components(a)
    top = max(values.max(), 1e-300)
    assert np.abs(got - np.sort(values)[::-1]).max() <= 1e-13 * top * 10
    assert np.abs(basis.T @ basis - np.eye(len(values))).max() < 1e-12
    assert np.abs(basis.T @ a @ basis - np.diag(got)).max() <= 1e-12 * top


def test_polar_factor():
    rng = np.random.default_rng(7)
    a = rng.standard_normal((30, 30))
    a = (a + a.T) / 2
    a /= np.linalg.norm(a)
    u = whitening.polar(a, 1e-6)
    assert np.abs(u @ u - np.eye(30)).max() < 1e-13 and np.linalg.eigvalsh(u @ a).min() > -1e-13
