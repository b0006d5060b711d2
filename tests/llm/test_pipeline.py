from collections import defaultdict

from pyspark.sql import functions as F

import corpus_pipeline
from dockflow.llm import quality
from dockflow.llm.queries import ORACLES, QUERIES
from tests.llm import brute
from tests.llm.test_operators import check_packing


def good(text):
    n, chars, symbols, dup, repeated, failed = brute.quality(text)
    lines = sum(bool(brute.WORD.search(x)) for x in (text or "").split("\n"))
    return not (failed or 100 * symbols > 20 * n or 100 * dup > 35 * lines or chars < 2 * n or chars > 14 * n or 100 * (text or "").count("!!") > 40 * n)


def survivors(rows):
    """(doc_id, text) after quality rules, exact dedup and near duplicates, by plain code."""
    rows = [(d, t) for d, t in rows if good(t)]
    last = {}
    for d, t in rows:
        key = brute.lower_ascii(t)
        if key not in last or d > last[key][0]:
            last[key] = (d, t)
    rows = list(last.values())
    heads = {c for _, c, _ in brute.near(rows)}
    return [(d, t) for d, t in rows if d in heads]


def test_run_equals_plain_code(spark, sf, real):
    rows = survivors([(r.doc_id, r.text) for r in real.select("doc_id", "text").collect()])
    got = corpus_pipeline.run(spark, sf).collect()
    assert {r.doc_id for r in got} == {d for d, _ in rows}
    check_packing(rows, got)


def test_stages_return_the_columns_of_documents(spark, sf, docs, nothing):
    for name, stage in corpus_pipeline.STAGES[:-1]:
        for df in (docs, nothing):
            out = stage(spark, df, sf)
            assert out.columns == df.columns and dict(out.dtypes) == dict(df.dtypes), name
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality rules", "exact dedup", "n-gram Jaccard join", "mixing sources to target weights", "packing"]


def test_mixed_files_follow_the_schedule(spark, real, tmp_path):
    from dockflow.llm import mixing

    path = str(tmp_path / "mixed")
    mixing.mix(real, block=4).write.parquet(path)
    order = spark.read.parquet(path).select("doc_id", "_metadata.file_name", "_metadata.row_index").orderBy("file_name", "row_index").collect()
    schedule = {r.doc_id: (r.slot, r.place) for r in mixing.mix_schedule(real, block=4).collect()}
    places = [schedule[r.doc_id] for r in order]
    assert places == sorted(places)


def test_clean_documents_stay(spark, sf, real):
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    kept = quality.keep_good(real).select("doc_id")
    long = quality.ledger(real).where("n_words >= 50 and 100 * n_repeat_words <= 50 * n_words").select("doc_id")
    clean = labels.where("quality = 1").join(long, "doc_id", "left_semi")
    assert clean.join(kept, "doc_id", "left_anti").count() == 0
    junk = labels.where("quality = 0")
    assert junk.join(kept, "doc_id", "left_anti").count() >= 0.9 * junk.count()


def test_one_query_per_operator():
    numbers = defaultdict(list)
    for name in QUERIES:
        numbers[int(name[2:].split("_")[0])].append(name)
    assert sorted(numbers) == list(range(1, 11)) and all(len(v) == 1 for v in numbers.values())
    assert set(ORACLES) <= set(QUERIES)


def test_a_lost_filter_bit_changes_nothing(docs):
    """A full filter lets every row through to the exact grouping."""
    from dockflow.llm import exact_dedup

    small = exact_dedup.dedup_ledger(docs, max_bits=1).select("doc_id", "keep_id", "group_size").collect()
    large = exact_dedup.dedup_ledger(docs).select("doc_id", "keep_id", "group_size").collect()
    assert sorted(map(str, small)) == sorted(map(str, large))


def test_native_plans_have_no_python(docs):
    from dockflow.llm import mixing, pii

    base = docs.select(*[pii.base_spans(F.coalesce("text", F.lit("")), k) for k in pii.KINDS])
    for df in (quality.ledger(docs), quality.keep_good(docs), mixing.mix_schedule(docs), base):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan
