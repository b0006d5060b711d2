"""Personal data and the terms that give it away, with DataFrame functions alone.

Base: e-mail and IP addresses, card and phone numbers by pattern and check (parts, Luhn, digits), with code-point spans.

Method (information-theoretic sanitisation): a found value is a protected entity ``e``. For each word ``t`` of a text that carries it, wherever it
stands, the corpus gives n(e), n(t) and n(e, t), in documents, and the disclosure of ``e`` by ``t`` is PMI(e; t) / IC(e) =
log(N n(e,t) / (n(e) n(t))) / log(N / n(e)): 1 when ``t`` never occurs without ``e``, 0 when the two are independent.
n(e, t) / n(t), the share of the term's documents that carry ``e``, is taken at its lower confidence bound (Wilson, one-sided 95 %), so few
documents count for less and none are too few. If the disclosure of ``t`` reaches ``threshold`` it is generalised in the documents that carry
``e``; from ``remove_at`` on it is removed. Documents with the same text count once; all counts cover all documents. Pairs whose disclosure
couldn't reach the threshold even if n(e, t) were as great as n(e) and n(t) allow aren't counted. Entities carried by the same texts have the same
counts with every term, so they are one class and are counted once: a list of addresses found nowhere else costs its words, not their product.

A null or empty text has no spans; repeated rows each get their own row; an empty table gives an empty result; other columns aren't read.
Patterns are possessive and start at run ends or at the end of the last match only, so texts of any length are matched in linear time and without
a stack.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dockflow.llm.common import let, staged

KINDS = ("email", "ip", "card", "phone")
#: The same matches as the plain patterns; a match may start after a character outside its first class or where the last one ended.
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9](?:[\x20-]?+[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: Texts without such a place have no match of the kind.
HINTS = {"email": "@", "ip": r"[0-9]\.[0-9]", "card": r"(?:[0-9][\x20-]?){15}[0-9]", "phone": r"\+[0-9]"}
WORD = r"\p{L}{3,}"
Z = 1.645
THRESHOLD = 0.8
REMOVE_AT = 0.95
BLOCK = 64


def found(text: Column, pattern: Column) -> Column:
    """array<struct<s, e, v>> of the pattern's matches, leftmost first; ``\\G`` keeps the scan linear.

    Offsets are summed in blocks of ``BLOCK`` matches from the blocks' own sums, as appending to one array copies it every time.
    """
    whole = F.concat(F.lit(r"\G((?s:.*?))("), pattern, F.lit(")"))
    gaps = F.transform(F.regexp_extract_all(text, whole, F.lit(1)), lambda g: F.length(g))
    pairs = F.arrays_zip(gaps.alias("g"), F.regexp_extract_all(text, whole, F.lit(2)).alias("v"))
    span = "struct<s:int,e:int,v:string>"

    def within(part: Column, base: Column) -> Column:
        def step(a: Column, x: Column) -> Column:
            s = a["at"] + x["g"]
            e = s + F.length(x["v"])
            return F.struct(e.alias("at"), F.concat(a["out"], F.array(F.struct(s.alias("s"), e.alias("e"), x["v"].alias("v")))).alias("out"))

        return F.aggregate(part, F.struct(base.alias("at"), F.expr(f"cast(array() as array<{span}>)").alias("out")), step, lambda a: a["out"])

    def placed(all_: Column) -> Column:
        count = F.floor((F.size(all_) + BLOCK - 1) / BLOCK).cast("int")
        parts = F.transform(F.filter(F.sequence(F.lit(0), count), lambda k: k < count), lambda k: F.slice(all_, k * BLOCK + 1, F.lit(BLOCK)))
        sums = lambda ps: F.transform(ps, lambda p: F.aggregate(p, F.lit(0), lambda a, x: a + x["g"] + F.length(x["v"])))
        bases = lambda ps: F.aggregate(sums(ps), F.array(F.lit(0)), lambda a, t: F.concat(a, F.array(F.element_at(a, -1) + t)))
        return let(parts, lambda ps: let(bases(ps), lambda at: F.flatten(F.transform(ps, lambda p, k: within(p, F.get(at, k))))))

    return let(pairs, placed)


def _luhn(digits: Column) -> Column:
    def value(c: Column, i: Column) -> Column:
        d = c.cast("int")
        return F.when(i % 2 == 0, d).when(d > 4, 2 * d - 9).otherwise(2 * d)

    chars = F.filter(F.split(F.reverse(digits), ""), lambda c: c != "")
    return F.aggregate(F.transform(chars, value), F.lit(0), lambda a, x: a + x) % 10 == 0


def _valid(kind: str, v: Column) -> Column:
    if kind == "ip":
        bare = lambda p: F.regexp_replace(p, "^0+", "")
        return F.forall(F.split(v, r"\."), lambda p: (F.length(bare(p)) <= 3) & (F.coalesce(bare(p).try_cast("int"), F.lit(0)) <= 255))
    if kind == "card":
        return let(F.regexp_replace(v, r"[\x20-]", ""), lambda d: F.when(F.length(d).between(16, 19), _luhn(d)).otherwise(False))
    if kind == "phone":
        return F.length(F.regexp_replace(v, "[^0-9]", "")).between(8, 15)
    return F.lit(True)


def base_spans(text: Column, kind: str) -> Column:
    none = F.expr("cast(array() as array<struct<s:int,e:int,v:string>>)")
    spans = F.filter(found(text, F.lit(PATTERNS[kind])), lambda x: _valid(kind, x["v"]))
    hint = F.contains(text, F.lit("@")) if kind == "email" else text.rlike(HINTS[kind])
    return F.when(hint, spans).otherwise(none)


def find_base(df: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """row, doc_id, hash and distinct words of the text, one span array per kind, and the text where there is a span; written below the shared folder."""
    body = F.coalesce(F.col(f"`{text}`").cast("string"), F.lit(""))
    rows = df.select(F.col(f"`{key}`").cast("long").alias("doc_id"), body.alias("text"))
    rows = rows.select("doc_id", "text", *[base_spans(F.col("text"), k).alias(k) for k in KINDS])
    some = sum((F.size(k) for k in KINDS), F.lit(0)) > 0
    return staged(rows.select(
        F.monotonically_increasing_id().alias("row"), "doc_id", F.xxhash64("text").alias("copy"), _words(F.col("text")).alias("words"),
        *KINDS, F.when(some, F.col("text")).alias("text")), "pii-base")


def _entity(kind: str, span: Column) -> Column:
    return F.concat(F.lit(f"{kind}:"), F.lower(span["v"]))


def _words(text: Column) -> Column:
    return F.array_distinct(F.regexp_extract_all(F.lower(text), F.lit(WORD), F.lit(0)))


def _entities(*keys: str) -> list[Column]:
    """Key columns and one row per distinct entity of a row's spans."""
    values = lambda k: F.transform(k, lambda x: _entity(k, x))
    return [*map(F.col, keys), F.explode(F.array_distinct(F.concat(*map(values, KINDS)))).alias("entity")]


def entity_classes(carried: DataFrame) -> DataFrame:
    """entity, class, n_entity from rows (copy, entity): entities of one class are carried by the same texts, told by their number and two sums of hashes."""
    total = F.sum(F.xxhash64("copy", F.lit(1)).cast("decimal(38,0)")).cast("string")
    mark = F.concat_ws(":", F.count("*"), total, F.bit_xor(F.xxhash64("copy", F.lit(2))))
    return carried.groupBy("entity").agg(F.unhex(F.md5(mark)).alias("class"), F.count("*").alias("n_entity"))


def _disclosure(n_both: Column, n_term: Column, n_entity: Column, total: Column, z: float) -> Column:
    n, p = n_term, n_both / n_term
    share = (p + z * z / (2 * n) - z * F.sqrt(p * (1 - p) / n + z * z / (4 * n * n))) / (1 + z * z / n)
    return F.log(share * total / n_entity) / F.log(total / n_entity)


def revealing_terms(base: DataFrame, threshold: float = THRESHOLD, remove_at: float = REMOVE_AT, z: float = Z) -> tuple[DataFrame, DataFrame]:
    """(entity, class) and (class, term, disclosure, removed) for every term over the threshold."""
    # One row stands for all documents with its text.
    own = staged(base.groupBy("copy").agg(F.min("row").alias("row")), "pii-copies")
    total = F.lit(float(max(own.count(), 1)))
    carriers = base.where(F.col("text").isNotNull()).select("row", "copy", "words", *KINDS)
    carriers = staged(carriers.join(own.select("row"), "row", "left_semi"), "pii-carriers")
    carried = carriers.select(*_entities("copy"))
    classes = staged(entity_classes(carried), "pii-classes")
    held = carried.join(classes, "entity").where(F.col("n_entity") < total).select("copy", "class", "n_entity").distinct()
    # Words of a text are distinct, so a task counts documents by counting words and shuffles its vocabulary. Words travel to the choice of
    # rows as one string, which takes a third of an array's room.
    listed = base.select("row", F.array_join("words", " ").alias("words")).join(own.select("row"), "row", "left_semi")
    words = listed.select(F.explode(F.split("words", " ")).alias("term"))
    n_term = words.groupBy("term").agg(F.count("*").alias("n_term"))
    # Words too common for any class go first, then those too common for the classes of their text.
    most = lambda n_entity: _disclosure(F.least("n_term", n_entity), F.col("n_term"), n_entity, total, z)
    largest = classes.where(F.col("n_entity") < total).agg(F.max("n_entity").alias("largest"))
    rare = n_term.crossJoin(F.broadcast(largest)).where(_reachable(F.col("n_term"), F.col("largest"), total, threshold)).drop("largest")
    seen = carriers.select("copy", F.explode("words").alias("term")).join(rare, "term")
    counted = seen.join(held, "copy").where(most(F.col("n_entity")) >= threshold).groupBy("class", "term", "n_term", "n_entity").agg(F.count("*").alias("n_both"))
    scored = counted.withColumn("disclosure", _disclosure(F.col("n_both"), F.col("n_term"), F.col("n_entity"), total, z))
    scored = scored.where(F.col("disclosure") >= threshold)
    return classes.select("entity", "class"), staged(scored.select("class", "term", "disclosure", (F.col("disclosure") >= remove_at).alias("removed")), "pii-terms")


def _reachable(n_term: Column, n_entity: Column, total: Column, threshold: float) -> Column:
    """Whether a term of ``n_term`` documents could disclose an entity of up to ``n_entity`` documents; grows with ``n_entity``."""
    return F.log(total / F.greatest(n_term, n_entity)) >= threshold * F.log(total / n_entity)


def find_terms(base: DataFrame, classes: DataFrame, revealing: DataFrame) -> DataFrame:
    """row, terms: spans of revealing terms in the documents that carry their entity."""
    carriers = base.where(F.col("text").isNotNull())
    carried = carriers.select(*_entities("row")).join(classes, "entity").select("row", "class").distinct().join(revealing, "class")
    wanted = carried.groupBy("row", "term").agg(F.max("removed").alias("removed"))
    words = carriers.select("row", F.explode(found(F.col("text"), F.lit(rf"{WORD}+"))).alias("x")).select("row", "x.s", "x.v")
    spans = words.join(wanted, (words["row"] == wanted["row"]) & (F.lower("v") == F.col("term"))).select(words["row"], "s", (F.col("s") + F.length("v")).alias("e"), "v", "removed")
    return spans.groupBy("row").agg(F.array_sort(F.collect_list(F.struct("s", "e", "v", "removed"))).alias("terms"))


def find_private(df: DataFrame, text: str = "text", key: str = "doc_id", **limits) -> DataFrame:
    """Every row of ``df`` once: row, doc_id, span arrays of the base kinds, ``terms`` outside these, and the text where there is a base span."""
    base = find_base(df, text, key)
    classes, revealing = revealing_terms(base, **limits)
    none = F.expr("cast(array() as array<struct<s:int,e:int,v:string,removed:boolean>>)")
    rows = base.drop("copy", "words").join(find_terms(base, classes, revealing), "row", "left").withColumn("terms", F.coalesce("terms", none))
    free = lambda x: ~F.exists(F.concat(*KINDS), lambda b: (b["s"] < x["e"]) & (x["s"] < b["e"]))
    return rows.withColumn("terms", F.filter("terms", free))


def sanitised(found_rows: DataFrame) -> DataFrame:
    """doc_id and sanitised text of the rows that hold a base span: values become their kind, terms are generalised or removed."""
    tagged = lambda k: F.transform(k, lambda x: F.struct(x["s"].alias("s"), x["e"].alias("e"), F.lit(f"[{k.upper()}]").alias("tag")))
    marks = F.concat(
        *map(tagged, KINDS),
        F.transform("terms", lambda x: F.struct(x["s"].alias("s"), x["e"].alias("e"), F.when(x["removed"], F.lit("")).otherwise(F.lit("[TERM]")).alias("tag"))),
    )
    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def step(a: Column, x: Column) -> Column:
        kept = F.concat(a["out"], F.substring(F.col("text"), a["at"] + 1, x["s"] - a["at"]), x["tag"])
        return F.struct(F.greatest(a["at"], x["e"]).alias("at"), F.when(x["s"] >= a["at"], kept).otherwise(a["out"]).alias("out"))

    body = F.aggregate(F.array_sort(marks), start, step, lambda a: F.concat(a["out"], F.substring(F.col("text"), a["at"] + 1, F.length("text"))))
    return found_rows.where(F.col("text").isNotNull()).select("doc_id", body.alias("text"))


def digest(found_rows: DataFrame) -> DataFrame:
    """doc_id, count per base kind, SHA-256 of the base spans, and all spans as kind:start:end."""
    listed = lambda kind: F.transform("terms" if kind == "term" else kind, lambda x: F.concat_ws(":", F.lit(kind), x["s"].cast("string"), x["e"].cast("string")))
    base = F.array_join(F.concat(*[listed(k) for k in KINDS]), ",")
    every = F.array_join(F.concat(*[listed(k) for k in (*KINDS, "term")]), ",")
    return found_rows.select("doc_id", *[F.size(k).cast("long").alias(f"n_{k}") for k in KINDS], F.sha2(base, 256).alias("base_sha256"), every.alias("spans"))
