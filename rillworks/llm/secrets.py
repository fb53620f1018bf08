"""Secret scan with corpus-wide ownership frequency, in DataFrame functions only.

Three base kinds and bare tokens are found by patterns in every whole text. A
candidate value is then counted over the corpus: by distinct repositories (pairs
of source and language) and distinct owners (sources). A value of many owners or of
many repositories is a copied example; one of few that looks random is taken for live. Live
bare tokens outside the base spans are added as spans; base spans always stay.

Positions come from the lengths of the matches and of the text between them.

Nulls and extras: a null text is empty; a null source or language counts as one
owner or repository of its own; rows with a null id are scanned like others;
repeated rows (same id and text) are scanned once and all get the result; a table
without ``source`` or ``lang`` has nulls there; other columns are ignored; an empty
table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rillworks.llm.land import land

# The patterns of the base kinds and their least lengths.
ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]+"
LEAST = {"assign": 8, "access": 16, "hex": 32}
KINDS = ("assign", "access", "hex", "bare")

#: A maximal token of 20 characters or more that holds a digit.
BARE = r"(?<![A-Za-z0-9+/_=-])(?=[A-Za-z+/_=-]*[0-9])[A-Za-z0-9+/_=-]{20,}"
#: Owners up to which a value counts as owner-specific.
FEW_OWNERS = 2
#: Repositories up to which it does.
FEW_REPOSITORIES = 4
#: Distinct characters from which a value looks random.
VARIED = 10


def _found(kind: str, text: Column, guard: Column, pattern: str, group: int) -> Column:
    """``kind``, and for each match its value, its length and the gap before it."""
    matches = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    values = F.regexp_extract_all(text, F.lit(pattern), F.lit(group)) if group else matches
    gaps = F.transform(F.split(text, pattern, -1), F.length)
    hits = F.arrays_zip(
        F.transform(matches, F.length).alias("size"), values.alias("value"), gaps.alias("gap")
    )
    return F.when(guard, F.struct(F.lit(kind).alias("kind"), hits.alias("hits")))


def candidates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id, of, owner, language, kind, start, end, value`` of every match that passes."""
    text = F.col("text")
    # Runs that cannot reach the least length are no hits for HEX and ACCESS, whose
    # matches are maximal; a short ASSIGN still uses up its text.
    kinds = F.array(
        _found("assign", text, (F.instr(text, "=") > 0) | (F.instr(text, ":") > 0), ASSIGN, 2),
        _found("access", text, F.instr(text, "AKIA") > 0, ACCESS[:-1] + "{%d,}" % (LEAST["access"] - 4), 0),
        _found("hex", text, text.rlike(HEX[:-1] + "{%d}" % LEAST["hex"]), HEX[:-1] + "{%d,}" % LEAST["hex"], 0),
        _found("bare", text, text.rlike("[0-9]"), BARE, 0),
    )
    rows = docs.select(
        F.col(id_col).alias("id"),
        F.xxhash64(text_col).alias("of"),
        *[
            (F.col(name) if name in docs.columns else F.lit(None)).cast("string").alias(into)
            for name, into in (("source", "owner"), ("lang", "language"))
        ],
        F.col(text_col).alias("text"),
    ).where(F.length("text") > 0)
    by_kind = rows.select("id", "of", "owner", "language", F.explode(F.filter(kinds, lambda k: k.isNotNull())).alias("k"))
    hits = by_kind.select(
        "id", "of", "owner", "language", F.col("k.kind").alias("kind"), F.posexplode("k.hits").alias("i", "hit")
    ).where("hit.size is not null")
    flat = hits.select("id", "of", "owner", "language", "kind", "i", "hit.*").distinct()
    # One text under one id: the owner columns do not split its positions.
    within = Window.partitionBy("id", "of", "owner", "language", "kind").orderBy("i")
    ends = F.sum(F.col("gap") + F.col("size")).over(within)
    placed = flat.withColumn("end", ends.cast("long")).withColumn("start", F.col("end") - F.col("size"))
    return placed.where(
        (F.col("kind") != "assign") | (F.length("value") >= LEAST["assign"])
    ).select("id", "of", "owner", "language", "kind", "start", "end", "value")


def ownership(found: DataFrame) -> DataFrame:
    """``value_hash, n_owners, n_repositories`` per distinct value."""
    # Owners first: copies within one repository leave one row before they meet.
    repositories = found.groupBy("value_hash", "owner", "language").agg(F.count("*").alias("n"))
    owners = repositories.groupBy("value_hash", "owner").agg(F.count("*").alias("repositories"))
    return owners.groupBy("value_hash").agg(
        F.count("*").alias("n_owners"), F.sum("repositories").alias("n_repositories")
    )


def _joined(spans: Column) -> Column:
    """Spans by start, then kind as listed, as ``kind:start:end`` with commas."""
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(
        F.transform(
            F.array_sort(spans),
            lambda s: F.concat_ws(":", F.element_at(names, s["order"]), s["start"].cast("string"), s["end"].cast("string")),
        ),
        ",",
    )


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: counts of base spans, their digest, all spans, and how values are owned."""
    order = F.array_position(F.array(*map(F.lit, KINDS)), F.col("kind")).cast("int")
    found = candidates(docs, id_col, text_col).withColumn("order", order)
    found = found.withColumn("value_hash", F.sha2("value", 256)).withColumn(
        "varied", F.size(F.array_distinct(F.split("value", ""))) >= VARIED
    )
    found = land(found.drop("value", "kind"), "candidates")
    base = F.col("order") <= 3
    owned = ownership(found)
    known = found.join(owned, "value_hash").withColumn(
        "copied", (F.col("n_owners") > FEW_OWNERS) | (F.col("n_repositories") > FEW_REPOSITORIES)
    ).withColumn("specific", ~F.col("copied") & F.col("varied"))
    spans = known.groupBy("id", "of", "order", "start", "end").agg(
        F.max("specific").alias("specific"), F.max("copied").alias("copied"),
        F.max("n_repositories").alias("n_repositories"),
    )
    by_start = Window.partitionBy("id", "of").orderBy("start", "order")
    before = by_start.rowsBetween(Window.unboundedPreceding, -1)
    after = by_start.rowsBetween(1, Window.unboundedFollowing)
    met = (F.coalesce(F.max(F.when(base, F.col("end"))).over(before), F.lit(-1)) > F.col("start")) | (
        F.coalesce(F.min(F.when(base, F.col("start"))).over(after), F.lit(2**62)) < F.col("end")
    )
    kept = spans.withColumn("met", met).where(base | (F.col("specific") & ~F.col("met")))
    span = F.struct("start", "order", "end")
    of_kind = lambda k: F.count_if(F.col("order") == KINDS.index(k) + 1)
    per_text = kept.groupBy(F.col("id").alias("_id"), F.col("of").alias("_of")).agg(
        of_kind("assign").alias("n_assign"),
        of_kind("access").alias("n_access"),
        of_kind("hex").alias("n_hex"),
        F.sha2(_joined(F.collect_list(F.when(base, span))), 256).alias("base_sha256"),
        _joined(F.collect_list(span)).alias("spans"),
        F.count_if("specific").alias("n_owner_specific"),
        F.count_if("copied").alias("n_widely_copied"),
        F.max("n_repositories").alias("most_repositories"),
    )
    rows = docs.select(F.col(id_col), F.xxhash64(text_col).alias("of"))
    joined = rows.join(per_text, F.col(id_col).eqNullSafe(F.col("_id")) & (F.col("of") == F.col("_of")), "left")
    count = lambda c: F.coalesce(c, F.lit(0)).cast("long").alias(c)
    return joined.select(
        id_col,
        count("n_assign"),
        count("n_access"),
        count("n_hex"),
        F.coalesce("base_sha256", F.sha2(F.lit(""), 256)).alias("base_sha256"),
        F.coalesce("spans", F.lit("")).alias("spans"),
        count("n_owner_specific"),
        count("n_widely_copied"),
        count("most_repositories"),
    )
