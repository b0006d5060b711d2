"""Quality rules as a bitmask ledger, with DataFrame functions alone.

Every rule is evaluated once per document: its measurements and one failure bit are stored in the ledger. A policy is a named,
versioned mask over the bits; applying it is one bitwise AND, and the effect of each rule under a policy (what it rejects, what only
it rejects) is a bitwise aggregate over the ledger, without reading the texts again.

Words are runs of anything but space, tab and U+000A-U+000D. A null or empty text has no words, fails ``few_words`` and is not kept.
Equal rows get equal ledger rows; an empty table gives an empty ledger; other columns aren't read.
Repeated three-word windows are found by sorting 64-bit window hashes of the one text, so a long text costs n log n.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dockflow.llm.common import let, texts_of

GAP = "[\\x20\\x09-\\x0D]+"
SYMBOLS = "[#*$%&|<>]"


@dataclass(frozen=True)
class Rule:
    """``failed`` is an SQL condition over the measurements of ``measure``."""

    name: str
    failed: str


RULES = (
    Rule("few_words", "n_words < 50"),
    Rule("repeated_windows", "100 * n_repeat_words > 50 * n_words"),
    Rule("symbols", "100 * n_symbols > 20 * n_words"),
    Rule("repeated_lines", "100 * n_dup_lines > 35 * n_lines"),
    Rule("short_words", "word_chars < 2 * n_words"),
    Rule("long_words", "word_chars > 14 * n_words"),
    Rule("shouting", "100 * n_shouted > 40 * n_words"),
)
BASE_RULES = ("few_words", "repeated_windows")


@dataclass(frozen=True)
class Policy:
    name: str
    version: int
    rules: tuple[str, ...]

    @property
    def mask(self) -> int:
        return mask_of(self.rules)


def mask_of(names: tuple[str, ...]) -> int:
    bit = {r.name: 1 << k for k, r in enumerate(RULES)}
    return sum(bit[n] for n in names)


POLICIES = (
    Policy("base", 1, BASE_RULES),
    Policy("default", 1, tuple(r.name for r in RULES if r.name != "shouting")),
    Policy("default", 2, tuple(r.name for r in RULES)),
)
CURRENT = POLICIES[-1]


def _repeat_words(words: Column) -> Column:
    """Words in three-word windows found twice or more, the first included."""
    hashes = F.slice(F.transform(words, lambda w, i: F.xxhash64(w, F.get(words, i + 1), F.get(words, i + 2))), 1, F.size(words) - 2)

    def covered(h: Column) -> Column:
        def marked(s: Column) -> Column:  # s: (hash, position) in order
            hits = F.array_sort(F.transform(F.filter(s, lambda x, k: (F.get(s, k - 1)["h"] == x["h"]) | (F.get(s, k + 1)["h"] == x["h"])), lambda x: x["i"]))
            return let(hits, lambda p: F.aggregate(
                F.transform(p, lambda x, k: F.least(F.lit(3), F.coalesce(F.get(p, k + 1) - x, F.lit(3)))), F.lit(0).cast("long"), lambda a, x: a + x,
            ))

        return let(F.array_sort(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i")))), marked)

    return F.when(F.size(words) < 4, F.lit(0).cast("long")).otherwise(
        let(hashes, lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0).cast("long")).otherwise(covered(h)))
    )


def _measured(rows: DataFrame, *carried: str) -> DataFrame:
    """``carried`` columns and the measurements of column ``text``."""
    words = F.filter(F.split("text", GAP), lambda w: w != "")
    lines = F.filter(F.split("text", "\n"), lambda x: x.rlike("[^\\x20\\x09-\\x0D]"))
    long = lambda c: c.cast("long")
    of_words = let(words, lambda w: F.struct(
        long(F.size(w)).alias("n_words"),
        F.aggregate(w, F.lit(0).cast("long"), lambda a, x: a + F.length(x)).alias("word_chars"),
        _repeat_words(w).alias("n_repeat_words"),
    ))
    of_lines = let(lines, lambda x: F.struct(long(F.size(x)).alias("n_lines"), long(F.size(x) - F.size(F.array_distinct(x))).alias("n_dup_lines")))
    return rows.select(
        *carried, of_words.alias("w"), of_lines.alias("l"),
        long(F.regexp_count("text", F.lit(SYMBOLS))).alias("n_symbols"), long(F.regexp_count("text", F.lit("!!"))).alias("n_shouted"),
    ).select(*carried, "w.*", "n_symbols", "l.*", "n_shouted")


def measure(df: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """doc_id and the measurements that the rules read, one row per row of ``df``."""
    return _measured(texts_of(df, key, text), "doc_id")


def failure_bits() -> Column:
    return sum((F.when(F.expr(r.failed), F.lit(1 << k).cast("long")).otherwise(F.lit(0).cast("long")) for k, r in enumerate(RULES)), F.lit(0).cast("long"))


def ledger(df: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """Measurements and ``failed_bits`` of every row of ``df``."""
    return measure(df, text, key).withColumn("failed_bits", failure_bits())


def passes(policy: Policy) -> Column:
    return F.col("failed_bits").bitwiseAND(F.lit(policy.mask)) == 0


def apply_policies(rows: DataFrame, policies: tuple[Policy, ...] = POLICIES) -> DataFrame:
    """The ledger with one verdict per policy version."""
    return rows.withColumns({f"kept_{p.name}_v{p.version}": passes(p) for p in policies})


def ablation(rows: DataFrame, policies: tuple[Policy, ...] = POLICIES) -> DataFrame:
    """Per policy and rule: rows the rule fails, rows only it fails, rows kept without it; one pass over the ledger."""
    items = [(p, k, r) for p in policies for k, r in enumerate(RULES) if r.name in p.rules]
    failed = lambda p: F.col("failed_bits").bitwiseAND(F.lit(p.mask))
    sums = []
    for n, (p, k, _) in enumerate(items):
        sums += [
            F.count_if(F.col("failed_bits").bitwiseAND(F.lit(1 << k)) != 0).alias(f"fails{n}"),
            F.count_if(failed(p) == (1 << k)).alias(f"only{n}"),
            F.count_if(F.col("failed_bits").bitwiseAND(F.lit(p.mask & ~(1 << k))) == 0).alias(f"kept{n}"),
        ]
    totals = rows.agg(*sums, F.count("*").alias("total"))
    return totals.select(F.inline(F.array(*[
        F.struct(F.lit(p.name).alias("policy"), F.lit(p.version).alias("version"), F.lit(r.name).alias("rule"), F.col("total").alias("n_docs"),
                 F.col(f"fails{n}").alias("n_failed"), F.col(f"only{n}").alias("n_failed_alone"), F.col(f"kept{n}").alias("n_kept_without"))
        for n, (p, k, r) in enumerate(items)
    ])))


def keep_good(df: DataFrame, policy: Policy = CURRENT, text: str = "text") -> DataFrame:
    """The rows of ``df`` that pass the policy, as they are: the bits are computed in place, nothing is shuffled."""
    own = df.columns
    at = {c: f"c{k}" for k, c in enumerate(own)}
    body = F.coalesce(F.col(at[text]).cast("string"), F.lit(""))
    packed = df.toDF(*at.values()).select(F.struct(*at.values()).alias("doc"), body.alias("text"))
    return _measured(packed, "doc").withColumn("failed_bits", failure_bits()).where(passes(policy)).select("doc.*").toDF(*own)
