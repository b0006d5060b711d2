"""Cases in which an operator once did less than its whole job."""

import random
import string

import corpus_pipeline
from pyspark.sql import functions as F

from dockflow.llm import mixing, pii, secrets, suffix_dedup
from tests.llm import brute
from tests.llm.test_operators import same


def letters(rng, n):
    return "".join(rng.choice(string.ascii_lowercase) for _ in range(n))


def test_suffix_dedup_keeps_new_surroundings_of_a_phrase(spark):
    """One document holds a minimiser in two stretches, of which a document of another slice has the first only."""
    rng = random.Random(3)
    phrases = [letters(rng, 40) for _ in range(50)]
    shared = "".join(letters(rng, 60) + p + letters(rng, 60) for p in phrases)
    rows = [(1, shared), (2, shared + "".join(letters(rng, 60) + p + letters(rng, 60) for p in phrases))]
    for those in (rows, [(2, rows[0][1]), (1, rows[1][1])]):
        df = spark.createDataFrame(those, "doc_id long, text string").repartitionByRange(2, "doc_id")
        got = suffix_dedup.dedup_suffixes(df).select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256)).collect()
        same(got, brute.suffixes(those))


def test_secrets_of_20_to_40_characters_in_prose(spark):
    """Random keys in prose are found in every length band; where words run together stand beside them, those are rarely taken for keys."""
    rng = random.Random(11)
    words = "the of and to in is that for it as was with be by on not he his but at are this have from or had an they which one you were all her she there would their we him been has when who will no more if out so said what up its about into than them can only other new some could time these two may then do first any my now such like our over man me even most made after also did many before must through back years where much your way well down should because each just those people mr how too little state good very make world still own see men work long get here between both life being under never day same another know while last might us great old year off come since against go came right used take three".split()
    text = lambda n: " ".join(rng.choice(words).capitalize() if rng.random() < 0.1 else rng.choice(words) for _ in range(n))
    letters = string.ascii_letters + string.digits
    rows, keys = [], {}
    for k in range(640):
        length = (20, 24, 28, 32, 36, 40)[k % 6]
        if k < 600:
            token = "".join(rng.choice(letters) for _ in range(length))
            keys[k] = length
        else:
            token = "".join(rng.choice(words).capitalize() for _ in range(14))[:length]
        rows.append((k, f"{text(60)} {token} {text(60)}"))
    for some in (rows[:600], rows):
        found = secrets.digest(secrets.find_secrets(spark.createDataFrame(some, "doc_id long, text string")))
        got = {r.doc_id: "random:" in r.spans for r in found.collect()}
        caught = {n: sum(got[k] for k in keys if keys[k] == n) for n in sorted(set(keys.values()))}
        wrong = sum(got[r[0]] for r in some if r[0] not in keys)
        print("caught of 100 by length", caught, "wrong", wrong, "of", len(some) - 600)
        assert wrong <= 6, (caught, wrong)
        assert len(some) > 600 or caught[20] >= 60 and min(caught[n] for n in caught if n > 20) >= 90, caught


def test_terms_of_rare_entities_and_fixed_signatures(spark):
    """A name beside an address in two documents, and one in a signature that is the same everywhere."""
    rows = [(k, f"{brute.prose(40, k)} and the usual matter") for k in range(1000)]
    rows += [(2000 + k, f"{brute.prose(25, 1000 + k)} quibblefax writes qq@mail.example.org and the usual {brute.prose(25, 1100 + k)}") for k in range(2)]
    rows += [(3000 + k, f"{brute.prose(40, 1200 + k)} regards from wobbletrix of the usual desk, ww@mail.example.org") for k in range(60)]
    rows += [(4000 + k, rows[1000][1]) for k in range(5)]  # copies
    found = pii.find_private(spark.createDataFrame(rows, "doc_id long, text string"))
    got = {r.doc_id: {x.v for x in r.terms} for r in found.select("doc_id", "terms").collect()}
    assert all("quibblefax" in got[k] for k in (2000, 2001, 4000))
    assert all("wobbletrix" in got[3000 + k] for k in range(60))
    assert not any({"and", "the", "usual"} & terms for terms in got.values())


def test_terms_far_from_their_entity(spark):
    """A name counts wherever it stands in the texts of an entity: before 200 words, behind one of 300 letters, cut by no window; lists of addresses too."""
    many = " ".join(f"p{k}@list.example.org" for k in range(60))
    far = f"quibblefax {brute.prose(200, 1)} QQ@mail.example.org {'y' * 300} snorkelby {brute.prose(100, 2)} Wobbletrix"
    rows = [(k, f"{brute.prose(300, 10 + k)} and the usual matter") for k in range(2000)]
    rows += [(9000, far), (9001, far.replace("QQ", "qq") + " usual"), (9002, f"{many} grumbletop {many}")]
    found = pii.find_private(spark.createDataFrame(rows, "doc_id long, text string"))
    got = {r.doc_id: {x.v for x in r.terms} for r in found.select("doc_id", "terms").collect()}
    assert all({"quibblefax", "y" * 300, "snorkelby", "Wobbletrix"} <= got[k] for k in (9000, 9001)), got[9000]
    assert got[9002] == {"grumbletop"} and "usual" not in got[9001]
    texts = dict(rows)
    assert all(texts[r.doc_id][x.s:x.e] == x.v for r in found.where("size(terms) > 0").collect() for x in r.terms)


def test_sequences_follow_the_schedule(spark, tmp_path):
    """Sequences are numbered by ranges of slots, however the mixed rows were dealt to files."""
    rng = random.Random(2)
    rows = [(k, brute.prose(20, k), "en", f"src{min(rng.randrange(9), 2)}", 1) for k in range(3000)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars int")
    slots = {r.doc_id: r.slot for r in mixing.mix_schedule(df).collect()}
    own = sorted(rows, key=lambda r: slots[r[0]])
    for k, (a, b) in enumerate(((0, 100), (100, 300), (300, 700), (700, 1500), (1500, 3000))):  # the largest file is read first
        spark.createDataFrame(own[a:b], df.schema).coalesce(1).write.parquet(f"{tmp_path}/docs/part={k}")
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        docs = spark.read.parquet(f"{tmp_path}/docs").select(*df.columns)
        got = corpus_pipeline.pack_sequences(spark, docs, "").select("doc_id", "sequence_id").collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)
    ranges = {}
    for r in got:
        ranges.setdefault(r.sequence_id >> 40, []).append(slots[r.doc_id])
    assert {r.doc_id for r in got} == slots.keys() and len(ranges) > 1
    ends = [(min(ranges[k]), max(ranges[k])) for k in sorted(ranges)]
    assert all(a[1] < b[0] for a, b in zip(ends, ends[1:])), ends


def test_stretches_whose_names_share_32_bits(spark):
    """Two texts without a common window, found by search: their stretches share minimiser and the low half of the name."""
    texts = ["ztfsnB2 EyB9hdvHK ps8 1Ksy5OQ1So9i6KstYwoivQ4xmlkd", "bpuZBRyRetB9hdvHK ps8 1Ksy5OQ1So9imMR9zYGEobe2WMqf"]
    df = spark.createDataFrame([(1, texts[0]), (2, texts[1])], "doc_id long, text string").repartition(2, "doc_id")
    assert {r["doc_id"]: r["n_removed"] for r in suffix_dedup.dedup_suffixes(df).collect()} == {1: 0, 2: 0}
