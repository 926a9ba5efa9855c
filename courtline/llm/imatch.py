"""I-Match document fingerprints, DataFrame operations only.

Terms are lower-cased words. The lexicon holds the terms whose document frequency lies in a band (neither so
common that they tell nothing, nor so rare that few documents share them). It is cut at random into subsets of
several densities; of each subset a document's distinct terms are sorted and hashed, and the hashes of the subsets
that it has terms in make up its fingerprint. A dense subset recognises near copies of short texts, a sparse one
those of long texts.

The lexicon is broadcast: with a document frequency of LEAST_SHARE or more of all documents it has at most
(mean distinct terms of a document / LEAST_SHARE) entries, whatever the number of documents.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from .common import repeated, row_hash, staged

LEAST_SHARE, MOST_SHARE = 0.001, 0.15       # of documents that hold a term: the idf band, as shares
LEVELS = ((16, 16), (64, 16), (256, 16), (1024, 32))    # (random parts of the lexicon, parts that are used)
WHOLE = 127                                 # slot of a text without a term in the band: all its terms
_LOW24 = (1 << 24) - 1
_SIDES = 3                                  # the two low bits of a term's hash are left to the side it is on


def _hash(word: Column) -> Column:
    return F.xxhash64(word).bitwiseAND(F.lit(~_SIDES))


def words(text: Column) -> Column:
    """Hashes of the distinct lower-cased words."""
    found = F.transform(F.split(F.lower(text), r"[\x20\x09-\x0D]+"), _hash)
    return F.array_except(found, F.array(_hash(F.lit(""))))


def lexicon(docs: DataFrame, text_col: str, total: int) -> DataFrame:
    """Hashes of the terms in the band. Counts are over all documents."""
    terms = docs.select(F.explode(words(F.col(text_col))).alias("term"))
    return terms.groupBy("term").agg(F.count(F.lit(1)).alias("df")) \
        .where((F.col("df") >= LEAST_SHARE * total) & (F.col("df") <= F.greatest(F.lit(1.0), F.lit(MOST_SHARE * total)))).select("term")


def _slots(term: Column) -> Column:
    """The used parts that a term falls in, at most one of each level."""
    first, out = 0, []
    for level, (parts, used) in enumerate(LEVELS):
        part = F.pmod(F.xxhash64(term, F.lit(level)), F.lit(parts))
        out.append(F.when(part < used, (part + first).cast("int")))
        first += used
    return F.array_compact(F.array(*out))


def likeness(a: Column, b: Column) -> Column:
    """Share of the subsets in which either has terms that hash alike."""
    slots = F.size(F.array_union(*(F.transform(x, lambda e: F.shiftright(e, 24)) for x in (a, b))))
    return (F.size(F.array_intersect(a, b)) / slots).cast("double")


def as_text(entries: Column) -> Column:
    return F.array_join(F.transform(entries, lambda e: F.lpad(F.lower(F.hex(e.cast("long"))), 8, "0")), "")


def _next_in_order(marks: DataFrame) -> DataFrame | None:
    """(row, doc_id, n_chars, copies, next_row, before_row, before_third): each document with its neighbours in descending id order,
    ends joined. Ranks come from one range exchange of the ids and the sizes of its partitions."""
    order = [F.col("doc_id").desc_nulls_last(), F.col("row")]
    low = (1 << 33) - 1
    ranged = staged(marks.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("part", F.spark_partition_id())
                    .withColumn("at", F.monotonically_increasing_id().bitwiseAND(F.lit(low))), "ordered")
    sizes = ranged.groupBy("part").agg(F.count(F.lit(1)).alias("n")).orderBy("part").collect()     # a row a partition
    total, first = 0, []
    for r in sizes:
        first.append((r.part, total))
        total += r.n
    if not total:
        return None
    starts = marks.sparkSession.createDataFrame(first, "part int, first long")
    ranked = ranged.join(F.broadcast(starts), "part").withColumn("rank", F.col("first") + F.col("at")) \
        .select("row", "doc_id", "n_chars", "copies", "rank")
    after = ranked.select(F.col("row").alias("next_row"), F.pmod(F.col("rank") - 1, F.lit(total)).alias("rank"))
    before = ranked.select(F.col("row").alias("before_row"), F.floor(F.col("n_chars") / 3).cast("int").alias("before_third"),
                           F.pmod(F.col("rank") + 1, F.lit(total)).alias("rank"))
    return ranked.join(after, "rank").join(before, "rank").drop("rank")


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next.

    The edited text is the text with its last third (floor of n_chars / 3) replaced by as much of the start of the
    next document, in descending id order, the first after the last. A null text is empty. Null ids come last in the
    order; of rows that share an id the hash of the text decides; rows equal in id and text are one document there,
    and each of them is returned. Texts without words have the fingerprint of no terms. A single document is its own
    next one. An empty table gives no row; other columns are ignored.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    base = docs.select(F.col(id_col).cast("long").alias("doc_id"), text.alias("text"), row_hash(id_col, text_col).alias("row"))
    marks = staged(base.select("row", "doc_id", F.length("text").alias("n_chars")), "fingerprint-marks")
    total = marks.count()
    own = marks.groupBy("row").agg(F.min("doc_id").alias("doc_id"), F.min("n_chars").alias("n_chars"), F.count(F.lit(1)).alias("copies"))
    links = _next_in_order(own)
    if links is None:
        return marks.limit(0).select(F.col("doc_id").alias(id_col), F.col("n_chars").cast("long"), *(F.lit("").alias(c) for c in (
            "edited_sha256", "fingerprint", "edited_fingerprint")), *(F.lit(0.0).alias(c) for c in ("near_edited", "near_next")))
    links = staged(links, "neighbours")
    band = staged(lexicon(base, "text", total), "lexicon")
    both = base.select("row", "text").join(links, "row")
    # the start of each document goes to the one before it, no longer than it is needed there
    starts = both.select(F.col("before_row").alias("row"), F.expr("substring(text, 1, before_third)").alias("start")).dropDuplicates(["row"])
    both = both.join(starts, "row").withColumn("edited", F.concat(
        F.expr("substring(text, 1, n_chars - cast(floor(n_chars / 3) as int))"), "start"))
    both = both.withColumn("a", words(F.col("text"))).withColumn("b", words(F.col("edited")))

    def whole(terms: str) -> Column:
        return (F.lit(WHOLE << 24) + F.xxhash64(F.array_sort(terms)).bitwiseAND(F.lit(_LOW24)).cast("int")).cast("int")

    info = F.struct("doc_id", F.col("n_chars").cast("long").alias("n_chars"), "copies", "next_row", F.sha2(F.col("edited").cast("binary"), 256).alias("sha"),
                    whole("a").alias("whole_a"), whole("b").alias("whole_b"))
    kind = "struct<doc_id:bigint,n_chars:bigint,copies:bigint,next_row:bigint,sha:string,whole_a:int,whole_b:int>"

    def tagged(terms: Column, side: int) -> Column:
        return F.transform(terms, lambda w: w.bitwiseOR(F.lit(side).cast("long")))

    # the first element, on no side, stands for the document itself, so one without a term in the band stays
    found = F.concat(F.array(F.lit(0).cast("long")), tagged(F.array_except("a", "b"), 1), tagged(F.array_except("b", "a"), 2),
                     tagged(F.array_intersect("a", "b"), 3))
    rows = both.select("row", info.cast(kind).alias("info"), found.alias("found")).select("row", "info", F.explode("found").alias("f"))
    side = F.col("f").bitwiseAND(F.lit(_SIDES).cast("long"))
    rows = rows.select("row", F.when(side == 0, F.col("info")).alias("info"), F.col("f").bitwiseAND(F.lit(~_SIDES)).alias("term"), side.cast("int").alias("side"))
    known = F.broadcast(band.unionByName(band.sparkSession.range(1).select(F.lit(0).cast("long").alias("term"))).distinct())
    slots = F.when(F.col("side") == 0, F.array(F.lit(-1))).otherwise(_slots(F.col("term")))
    rows = rows.join(known, "term").select("row", "info", "term", "side", F.explode(slots).alias("slot"))

    def entry(side: int) -> Column:
        terms = F.sort_array(F.collect_list(F.when(F.col("side").isin(side, 3), F.col("term"))))
        return F.when(F.size(terms) > 0, (F.shiftleft(F.col("slot"), 24) + F.xxhash64(terms).bitwiseAND(F.lit(_LOW24)).cast("int")))

    hashed = rows.groupBy("row", "slot").agg(entry(1).alias("a"), entry(2).alias("b"), F.first("info", ignorenulls=True).alias("info"))
    prints = hashed.groupBy("row").agg(F.sort_array(F.collect_list("a")).alias("a"), F.sort_array(F.collect_list("b")).alias("b"),
                                       F.first("info", ignorenulls=True).alias("info"))
    prints = prints.select("row", "info.*", *(F.when(F.size(x) > 0, F.col(x)).otherwise(F.array(f"info.whole_{x}")).alias(x) for x in ("a", "b")))
    prints = staged(prints.drop("whole_a", "whole_b"), "prints")
    after = prints.select(F.col("row").alias("next_row"), F.col("a").alias("c"))
    out = prints.join(after, "next_row").select(
        F.col("doc_id").alias(id_col), "n_chars", F.col("sha").alias("edited_sha256"), as_text(F.col("a")).alias("fingerprint"),
        as_text(F.col("b")).alias("edited_fingerprint"), likeness(F.col("a"), F.col("b")).alias("near_edited"),
        likeness(F.col("a"), F.col("c")).alias("near_next"), "copies")
    return repeated(out, "copies")      # equal rows come back as often as they were there
