import random
import struct
import tracemalloc
import zlib
from collections import Counter, defaultdict

import public_tokenizers
import pytest
from pyspark.sql import functions as F

from dockflow.llm import chunk_dedup, exact_dedup, mixing, ngram_join, packing, pii, quality, secrets, suffix_dedup, token_counts
from tests.llm import brute
from tests.llm.conftest import CLASHES

PIECES = public_tokenizers.path("piece_bpe_32k.model")
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")


def both(docs, real):
    return ((docs, [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]), (real, [(r.doc_id, r.text) for r in real.select("doc_id", "text").collect()]))


def same(got, wanted):
    key = lambda r: tuple((v is None, str(v)) for v in r)
    got, wanted = sorted(map(tuple, got), key=key), sorted(map(tuple, wanted), key=key)
    bad = [(a, b) for a, b in zip(got, wanted) if a != b]
    assert not bad, bad[:3]
    assert len(got) == len(wanted)


def test_secrets(docs, real, nothing):
    for df, rows in both(docs, real):
        got = secrets.digest(secrets.find_secrets(df)).collect()
        wanted = []
        for d, t in rows:
            spans = brute.secrets_base(t or "")
            wanted.append((d, *(sum(s[0] == k for s in spans) for k in ("assign", "access", "hex")), brute.sha(brute.joined(spans))))
        same([r[:5] for r in got], wanted)
    assert secrets.digest(secrets.find_secrets(nothing)).count() == 0


def test_secret_battery_tells_random_from_text(spark):
    rng = random.Random(5)
    letters = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"
    words = "the and there here ether then hear rather another other than that tone one note".split()
    text = lambda n: " ".join(rng.choice(words) for _ in range(n))
    rows = []
    for k in range(600):
        key = "".join(rng.choice(letters) for _ in range(44)) if k < 300 else text(20).replace(" ", "")[:44]
        rows.append((k, f"{text(80)} key {key} {text(60)}"))
    got = {r.doc_id: r.spans for r in secrets.digest(secrets.find_secrets(spark.createDataFrame(rows, "doc_id long, text string"))).collect()}
    caught = sum("random:" in got[k] for k in range(300))
    wrong = sum("random:" in got[k] for k in range(300, 600))
    assert caught >= 270 and wrong <= 6, (caught, wrong)
    start = rows[0][1].index(" key ") + 5
    assert got[0] in ("", f"random:{start}:{start + 44}")


def test_short_strings_are_not_told_from_text(spark):
    rng = random.Random(6)
    rows = [(k, f"{brute.prose(30, k)} {''.join(rng.choice('abcdefghijklmnopqrstuvwxyz') for _ in range(20))} {brute.prose(30, k + 1)}") for k in range(50)]
    found = secrets.find_secrets(spark.createDataFrame(rows, "doc_id long, text string"))
    assert found.where("size(spans) > 0").count() == 0


@pytest.mark.parametrize("kind", ["random", "periodic"])
def test_a_text_without_spaces_costs_linear_memory(kind):
    import sentencepiece

    model, units, rng = sentencepiece.SentencePieceProcessor(model_file=PIECES), token_counts.compiled(PIECES), random.Random(5)

    def counted(n):
        text = "".join(rng.choice("etaoinshrdlu") for _ in range(n)) if kind == "random" else "ab" * (n // 2)
        maps = []
        for a in range(0, n, token_counts.CHUNK):
            body, before = token_counts.prepared(text[a:a + token_counts.CHUNK], a == 0), text[max(0, a - token_counts.CONTEXT):a]
            maps.append(token_counts.chunk_map(body, units, token_counts.entry_state(before, body, units)))
        tracemalloc.start()
        got = token_counts.total(token_counts.scan_total(maps, lambda x, y: token_counts.compose(x, y, units)), units)
        peak = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        return got, len(model.encode(text)), peak

    for n in (200_000, 1_000_000):
        got, wanted, peak = counted(n)
        assert got == wanted and peak < 4 * n + 1_000_000


def test_tokens(docs, real, nothing):
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    for df, rows in both(docs, real):
        for chunk in (token_counts.CHUNK, 97):
            got = token_counts.count_tokens(df, PIECES, chunk=chunk).collect()
            same(got, [(d, len((t or "").encode()), n := len(model.encode(t or "")), n > 4096) for d, t in rows])
    assert token_counts.count_tokens(nothing, PIECES).count() == 0


def test_transducer_on_random_strings():
    import sentencepiece

    model, units, rng = sentencepiece.SentencePieceProcessor(model_file=PIECES), token_counts.compiled(PIECES), random.Random(3)
    for _ in range(3000):
        text = "".join(rng.choice("  ab etnrsi.,\n\t01é漢▁😀-<>_") for _ in range(rng.randint(0, 60)))
        whole = token_counts.chunk_map(token_counts.prepared(text, True), units)
        assert token_counts.total(whole, units) == len(model.encode(text)), text
        cut = rng.randint(1, 9)
        maps = []
        for a in range(0, max(1, len(text)), cut):
            body, before = token_counts.prepared(text[a:a + cut], a == 0), token_counts.prepared(text[max(0, a - rng.randint(0, 9)):a], False)
            maps.append(token_counts.chunk_map(body, units, token_counts.entry_state(before, body, units)))
        last = token_counts.scan_total(maps, lambda a, b: token_counts.compose(a, b, units))
        assert token_counts.total(last, units) == len(model.encode(text)), (text, cut)


@pytest.mark.parametrize("block", [1, 3])
def test_mixing(docs, nothing, block):
    rows = docs.select("doc_id", "source").collect()
    counts = Counter(r.source for r in rows)
    roots = {s: int(n**0.5) for s, n in counts.items()}
    shares = {s: max(1, 1000 * r // sum(roots.values())) for s, r in roots.items()}
    got = mixing.mix_schedule(docs, block=block).collect()
    same([(r.doc_id, r.source) for r in got], [(r.doc_id, r.source) for r in rows])
    slots = brute.edf(shares, {s: -(-n // block) for s, n in counts.items()})
    sizes, frame = Counter((r.source, r.block) for r in got), sum(shares.values())
    for r in got:
        assert slots[r.source, r.block] == r.slot and r.release <= r.slot < r.deadline
    assert len({(r.slot, r.place) for r in got}) == len(got)
    for s, n in counts.items():
        assert [sizes[s, k] for k in range(-(-n // block))] == [block] * (n // block) + [n % block] * (n % block > 0)
    for at in range(0, max(r.slot for r in got) + 2):  # less than one block from the due share, while the source lasts
        for s, p in shares.items():
            mine = len({r.block for r in got if r.source == s and r.slot < at})
            assert mine == -(-counts[s] // block) or abs(mine - at * p / frame) < 1
    assert mixing.mix_schedule(nothing).count() == 0


def test_mixing_given_shares_and_rows(spark, docs, nothing):
    shares = spark.createDataFrame([("src0", 3), ("absent", 9)], "source string, share long")
    got = {r.source: r for r in mixing.mix_schedule(docs, shares, block=2).where("block = 1").groupBy("source").agg(F.min("slot").alias("slot")).collect()}
    assert set(got) == {"src0", "src1", "src2", None}
    mixed = mixing.mix(docs)
    assert mixed.columns == docs.columns and sorted(map(str, mixed.collect())) == sorted(map(str, docs.collect()))
    assert mixing.mix(nothing).columns == nothing.columns and mixing.mix(nothing).count() == 0


def test_near(docs, real, nothing):
    for df, rows in both(docs, real):
        same(ngram_join.near_join(df).collect(), brute.near(rows))
    assert ngram_join.near_join(nothing).count() == 0


def test_near_blocks(docs, monkeypatch):
    monkeypatch.setattr(ngram_join, "VERIFY_BLOCK", 3)
    monkeypatch.setattr(ngram_join, "BUCKET_BLOCK", 4)
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    same(ngram_join.near_join(docs).collect(), brute.near(rows))


def test_near_keeps_one_of_each_group(docs, real, nothing):
    for df, rows in both(docs, real):
        kept = ngram_join.drop_near(df)
        groups = {c for _, c, _ in brute.near(rows)}
        assert kept.columns == df.columns
        ids = [r.doc_id for r in kept.collect()]
        assert len(ids) == len(groups) and {i for i in ids if i is not None} <= {d for d, _ in rows}
    assert ngram_join.drop_near(nothing).count() == 0


def test_banding_reaches_its_recall():
    bands, rows = ngram_join.bands_for(0.8, 0.9999)
    assert 1 - (1 - 0.8**rows) ** bands >= 0.9999 and bands * rows <= ngram_join.MAX_HASHES


def check_packing(rows, got):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    streams = Counter()
    wanted = defaultdict(list)
    for d, t in rows:
        ids = tokenizer.encode(t or "", add_special_tokens=False).ids + [0]
        wanted[d].append(ids)
    pieces, used = defaultdict(list), defaultdict(list)
    for r in got:
        pieces[r.doc_id].append(r)
        used[r.sequence_id].append((r.offset, r.length))
    for d, streams in wanted.items():
        left = list(pieces[d])
        for ids in streams:
            at = 0
            while at < len(ids):
                part = next(p for p in left if p.start == at and p.doc_tokens == len(ids) and p.ids_crc32 == zlib.crc32(struct.pack(f"<{p.length}I", *ids[at:at + p.length])))
                left.remove(part)
                at += part.length
            assert at == len(ids)
        assert not left
    padding = 0
    for spans in used.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at and length > 0
            at += length
        assert at <= 1024
        padding += 0 if at & (at - 1) == 0 else 1024 - at
    assert padding == 0


def test_packing(docs, real, nothing):
    for df, rows in both(docs, real):
        check_packing(rows, packing.pack(df, RANKS, public_tokenizers.PATTERN).collect())
    assert packing.pack(nothing, RANKS, public_tokenizers.PATTERN).count() == 0


def test_ids_of_random_strings():
    from tokenizers import Tokenizer

    tokenizer, rng = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json")), random.Random(4)
    units = packing.tokenizer(RANKS, public_tokenizers.PATTERN, "<|endoftext|>", 50256)
    for _ in range(3000):
        text = "".join(rng.choice(["  ", " ", "a", "B", "'s", "'ll", "\n", "\t", "\x1c", "\x85", " ", " ", "　", "1", "22", "!", "é", "漢", "😀", "<|endoftext|>", "<|", "ing"]) for _ in range(rng.randint(0, 25)))
        ids = tokenizer.encode(text, add_special_tokens=False).ids
        assert units.ids(text) == struct.pack(f"<{len(ids)}I", *ids), text


def test_sum_of_squares_takes_the_best_level():
    out, rng = [], random.Random(2)
    packer = packing.SumOfSquares(16, out.append)
    for k in range(2000):
        size = rng.randint(1, 15)
        n = packer.levels.copy()
        level = packer.best_level(size)

        def squares(h):
            m = n.copy()
            if h:
                m[h] -= 1
            if h + size < 16:
                m[h + size] += 1
            return int((m[1:16] ** 2).sum())

        fits = [0, *[h for h in range(1, 17 - size) if n[h] > 0]]
        assert squares(level) == min(map(squares, fits))
        packer.place((k, 0, b"\0" * 4 * size, size), size)
    packer.close()
    assert not packer.open and all(sum(len(p[2]) // 4 for p in w) <= 16 for w in out)


def test_suffix_array():
    rng = random.Random(1)
    for _ in range(2000):
        text = [rng.randint(0, rng.choice([1, 2, 4])) for _ in range(rng.randint(0, 40))]
        assert suffix_dedup.suffix_array(text) == sorted(range(len(text)), key=lambda i: text[i:])


@pytest.mark.parametrize("most", [suffix_dedup.MAX_STRINGS, 2])
def test_suffix_dedup(docs, real, nothing, monkeypatch, most):
    monkeypatch.setattr(suffix_dedup, "MAX_STRINGS", most)
    for df, rows in both(docs, real):
        got = suffix_dedup.dedup_suffixes(df).select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256)).collect()
        same(got, brute.suffixes(rows))
    assert suffix_dedup.dedup_suffixes(nothing).count() == 0


def test_private(docs, real, nothing):
    for df, rows in both(docs, real):
        got = pii.digest(pii.find_private(df)).collect()
        wanted = []
        for d, t in rows:
            spans = brute.private_base(t or "")
            wanted.append((d, *(sum(s[0] == k for s in spans) for k in pii.KINDS), brute.sha(brute.joined(spans))))
        same([r[:6] for r in got], wanted)
        base = {(r[0], r.spans) for r in got}
        for d, t in rows:
            assert any(x == d and s.startswith(brute.joined(brute.private_base(t or ""))) for x, s in base)
    assert pii.digest(pii.find_private(nothing)).count() == 0


def test_revealing_terms(spark):
    rows = [(k, f"{brute.prose(20, k)} zorblat ask ann{'x' * 2}@mail.example.org about it and the usual {brute.prose(20, k + 50)}") for k in range(8)]
    rows += [(100 + k, f"{brute.prose(30, 200 + k)} about it and the usual matter") for k in range(200)]
    rows += [(400, "zorblat alone")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    found = pii.find_private(df)
    got = {r.doc_id: r for r in found.collect()}
    for k in range(8):
        text = rows[k][1]
        terms = [text[x.s:x.e] for x in got[k].terms]
        assert "zorblat" in terms and not {"about", "and", "the", "usual"} & set(terms)
    assert all(not got[k].terms for k in [*range(100, 300), 400])
    clean = {r.doc_id: r.text for r in pii.sanitised(found).collect()}
    assert set(clean) == set(range(8)) and all("zorblat" not in t and "[EMAIL]" in t and "@" not in t and "about it and the usual" in t for t in clean.values())


def test_quality(docs, real, nothing):
    for df, rows in both(docs, real):
        ledger = quality.ledger(df)
        got = ledger.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", ~quality.passes(quality.POLICIES[0])).collect()
        same(got, [(d, *brute.quality(t)) for d, t in rows])
        kept = quality.keep_good(df)
        assert kept.columns == df.columns
        same([(r.doc_id, r.text) for r in kept.collect()], [(r.doc_id, r.text) for r in df.withColumn("at", F.lit(0)).join(ledger.where(quality.passes(quality.CURRENT)).select("doc_id").distinct(), "doc_id", "left_semi").collect() if not brute.quality(r.text)[-1]] + [(d, t) for d, t in rows if d is None and not brute.quality(t)[-1]])
    assert quality.ledger(nothing).count() == 0 and quality.keep_good(nothing).count() == 0


def test_quality_policies_and_ablation(docs):
    ledger = quality.ledger(docs)
    bits = [r.failed_bits for r in ledger.collect()]
    table = {(r.policy, r.version, r.rule): r for r in quality.ablation(ledger).collect()}
    for p in quality.POLICIES:
        for k, rule in enumerate(quality.RULES):
            if rule.name in p.rules:
                r = table[p.name, p.version, rule.name]
                assert (r.n_docs, r.n_failed) == (len(bits), sum(b >> k & 1 for b in bits))
                assert r.n_failed_alone == sum(b & p.mask == 1 << k for b in bits) and r.n_kept_without == sum(b & p.mask & ~(1 << k) == 0 for b in bits)
    verdicts = quality.apply_policies(ledger).collect()
    assert all(r["kept_default_v2"] <= r["kept_default_v1"] <= r["kept_base_v1"] for r in verdicts)


def test_gear_cuts():
    body = brute.prose(3000, 3).encode()
    ends = chunk_dedup.cuts(body)
    assert ends[-1] == len(body) and all(a < b for a, b in zip(ends, ends[1:]))
    parts = {body[a:b] for a, b in zip([0, *ends], ends)}
    moved = body[:5000] + b"inserted words" + body[5000:]
    ends = chunk_dedup.cuts(moved)
    again = [moved[a:b] for a, b in zip([0, *ends], ends)]
    assert sum(p not in parts for p in again) <= 8
    for text in ("é" * 2000, "漢" * 999, "", "x", "a" * 5000):
        own = chunk_dedup.cuts(text.encode())
        for a, b in zip([0, *own], own):
            text.encode()[a:b].decode()


def test_chunk_dedup(docs, real, nothing):
    for df, rows in both(docs, real):
        rank = lambda d: -1 if d is None else d
        parts, first = {}, {}
        hashes = {(r.doc_id, r.text): r.h for r in df.select("doc_id", "text", F.xxhash64(F.coalesce("text", F.lit(""))).alias("h")).collect()}
        for d, t in rows:
            b = (t or "").encode()
            own = chunk_dedup.cuts(b)
            parts[d, t] = (b, own)
            for x, y in zip([0, *own], own):
                k = b[x:y]
                first[k] = min(first.get(k, (10**9, 0)), (rank(d), hashes[d, t]))
        wanted = []
        for d, t in rows:
            b, own = parts[d, t]
            late = [k for k, (x, y) in enumerate(zip([0, *own], own)) if first[b[x:y]] != (rank(d), hashes[d, t])]
            wanted.append((d, *chunk_dedup.strip(b, own, late, chunk_dedup.MIN_RUN)))
        same(chunk_dedup.dedup_chunks(df).collect(), wanted)
    assert chunk_dedup.dedup_chunks(nothing).count() == 0


def test_shared_passage_is_removed_once(spark):
    passage = brute.prose(60, 77)
    rows = [(k, f"{brute.prose(50, 300 + k)} {passage} {brute.prose(50, 600 + k)}") for k in range(6)] + [(50, brute.prose(120, 999))]
    got = {r.doc_id: r for r in chunk_dedup.dedup_chunks(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[0].n_removed == 0 and got[50].n_removed == 0
    assert all(got[k].n_removed > 0.6 * len(passage) for k in range(1, 6))


@pytest.mark.parametrize("most", [exact_dedup.MAX_BITS, 1 << 16])
def test_exact(docs, real, nothing, most):
    for df, rows in both(docs, real):
        groups = defaultdict(list)
        for d, t in rows:
            groups[brute.lower_ascii(t or "")].append(d)
        best = {k: max((d for d in v if d is not None), default=None) for k, v in groups.items()}
        got = exact_dedup.dedup_ledger(df, max_bits=most).collect()
        same([(r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got], [(d, best[k], len(groups[k]), brute.sha(k)) for d, t in rows for k in [brute.lower_ascii(t or "")]])
        kept = [r for r in got if r.kept]
        assert len(kept) == len(groups) and all(r.doc_id == r.keep_id for r in kept)
        stay = exact_dedup.drop_exact(df, max_bits=most)
        assert stay.columns == df.columns
        assert sorted((str(r.doc_id), brute.lower_ascii(r.text or "")) for r in stay.collect()) == sorted((str(d), k) for k, d in best.items())
    assert exact_dedup.dedup_ledger(nothing).count() == 0 and exact_dedup.drop_exact(nothing).count() == 0


def test_extra_columns_come_back(docs):
    for out in (exact_dedup.drop_exact(docs), quality.keep_good(docs), ngram_join.drop_near(docs), mixing.mix(docs)):
        assert out.columns == docs.columns and all(r[c] == "x" for r in out.collect() for c in CLASHES)
