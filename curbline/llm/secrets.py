"""Secret scan with multipart credential linking, DataFrame functions alone.

1. One scan takes each pattern's matches apart (``regexp_extract_all`` gives the
   matches, ``split`` what stands between them), and writes their lengths: a few
   numbers per match. A running sum per document and kind gives positions.
2. Strong kinds count by themselves. Weak parts (a bare 40-character secret, a
   temporary access identifier, an endpoint) are only candidates.
3. Linking is an interval join within a document: a candidate's interval,
   widened by ``scope`` characters, must overlap the intervals of its
   complementary parts. Positions are cut into bins of ``scope`` characters and
   joined on document and bin, so the work per bin is bounded by its length.
   A weak secret or identifier needs the other one; an endpoint needs both.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from curbline.llm.common import only, written

#: kind: (pattern, least length, the group that must have it); base kinds first.
PATTERNS = {
    "assign": (r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 6, 2),
    "access": (r"AKIA[A-Z0-9]+", 20, 0),
    # runs of 24 or more are exactly the matches of [0-9a-f]+ that are kept
    "hex": (r"[0-9a-f]{24,}", 24, 0),
    "temp_access": (r"(?<![A-Z0-9])ASIA[A-Z0-9]{16}(?![A-Z0-9])", 20, 0),
    "secret40": (r"(?<![A-Za-z0-9/+=])(?=[a-z0-9/+]*[A-Z])(?=[A-Z0-9/+]*[a-z])(?=[A-Za-z/+]*[0-9])[A-Za-z0-9/+]{40}(?![A-Za-z0-9/+=])", 40, 0),
    "endpoint": (r"https?://[A-Za-z0-9.-]+(?::[0-9]+)?", 10, 0),
}
BASE_KINDS = ("assign", "access", "hex")
KINDS = tuple(PATTERNS)
IDENTIFIERS = ("access", "temp_access")
SECRETS = ("assign", "secret40")
#: What must be near a weak part: every group needs one member in scope.
NEEDS = {"temp_access": (SECRETS,), "secret40": (IDENTIFIERS,), "endpoint": (IDENTIFIERS, SECRETS)}


def _matches(text: Column, kind: str) -> Column:
    """Per match of a kind: characters before it (since the last), its own, and if it counts."""
    pattern, least, group = PATTERNS[kind]
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    tested = found if group == 0 else F.regexp_extract_all(text, F.lit(pattern), F.lit(group))
    between = F.split(text, pattern, -1)
    number = F.lit(KINDS.index(kind))
    parts = F.zip_with(
        F.zip_with(between, found, lambda b, f: F.struct(F.char_length(b).alias("gap"), F.char_length(f).alias("size"))),
        tested, lambda p, t: F.struct(number.alias("kind"), p["gap"].alias("gap"), p["size"].alias("size"),
                                      (F.char_length(t) >= least).alias("counts")))
    # the text after the last match has no match of its own
    parts = F.filter(parts, lambda p: p["size"].isNotNull())
    none = F.array().cast("array<struct<kind:int,gap:int,size:int,counts:boolean>>")
    return F.when(text.rlike(pattern), parts).otherwise(none)


def _near(weak: DataFrame, others: DataFrame, scope: int) -> DataFrame:
    """The weak parts whose interval widened by ``scope`` overlaps one of the others."""
    def bins(lo: Column, hi: Column) -> Column:
        return F.explode(F.sequence(F.floor(lo / scope), F.floor(hi / scope)))

    w = weak.withColumn("bin", bins(F.greatest(F.col("start") - scope, F.lit(0)), F.col("end") + scope))
    o = others.select(F.col("rid").alias("o_rid"), F.col("start").alias("o_start"), F.col("end").alias("o_end"),
                      bins(F.col("start"), F.col("end")).alias("o_bin"))
    on = [w["rid"] == o["o_rid"], w["bin"] == o["o_bin"], o["o_start"] <= w["end"] + scope, o["o_end"] >= w["start"] - scope]
    return w.join(o, reduce(Column.__and__, on), "left_semi").drop("bin").distinct()


def find_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", scope: int = 256,
                 row_key: str = "row_key") -> DataFrame:
    """(``row_key``, id, ``spans``) per row of ``docs``.

    ``spans`` is an array of (``start``, ``rank``, ``end``, ``kind``), in that
    order: code points, end exclusive, ``rank`` the kind's place in ``KINDS``.
    Base kinds are always there, weak ones only when linked. Null and empty
    texts have no spans. Ids may be null or repeated: ``row_key``, a row's
    place in the scan, tells rows apart, so ``docs`` should be a stored table.
    Columns other than the two named are not looked at.
    """
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    parts = written(
        only(docs, [id_col, text_col])
        .select(F.monotonically_increasing_id().alias("rid"), F.col(f"`{id_col}`").alias("id"),
                F.concat(*[_matches(text, k) for k in KINDS]).alias("parts")), "secret-parts")
    each = parts.select("rid", F.posexplode("parts").alias("place", "part")).select("rid", "place", "part.*")
    before = Window.partitionBy("rid", "kind").orderBy("place")
    end = F.sum(F.col("gap").cast("long") + F.col("size")).over(before)
    spans = written(each.withColumn("end", end).where("counts")
                    .select("rid", F.col("kind").alias("rank"), (F.col("end") - F.col("size")).alias("start"), "end"), "secret-spans")

    def of(kinds) -> DataFrame:
        return spans.where(F.col("rank").isin([KINDS.index(k) for k in kinds]))

    found = of(BASE_KINDS)
    for kind, groups in NEEDS.items():
        linked = of([kind])
        for group in groups:
            linked = _near(linked, of(group), scope)
        found = found.union(linked)
    name = F.element_at(F.array(*map(F.lit, KINDS)), F.col("rank") + 1)
    grouped = found.groupBy("rid").agg(F.sort_array(F.collect_list(
        F.struct("start", "rank", "end", name.alias("kind")))).alias("spans"))
    none = F.array().cast("array<struct<start:bigint,rank:int,end:bigint,kind:string>>")
    return parts.select("rid", "id").join(grouped, "rid", "left").select(
        F.col("rid").alias(row_key), F.col("id").alias(id_col), F.coalesce("spans", none).alias("spans"))
