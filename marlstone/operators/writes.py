"""Writes as functions from a table's state to its next state.

Tables are values here: each function takes DataFrames and returns the DataFrame after the write, to
be stored by the caller (a new version, or a MERGE where the format has one). Keys are compared
null-safely where a unique key may hold nulls. All are joins on the key or filters; none collects.

Defined results
- Repeated rows of the new data count once; where they differ, the greatest struct of their values holds.
- Empty new data leaves the state as it was; an empty state takes all new rows that the write adds.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .pages import insert_ignore, upserted


def one_per_key(rows: DataFrame, key: Sequence[str]) -> DataFrame:
    """One row a key: the greatest of its differing rows."""
    rest = [c for c in rows.columns if c not in key]
    if not rest:
        return rows.distinct()
    return rows.groupBy(*key).agg(F.max(F.struct(*rest)).alias("__r")).select(*[F.col(c) if c in key else F.col(f"__r.{c}").alias(c) for c in rows.columns])


def deleted(df: DataFrame, doomed: DataFrame, key: Sequence[str]) -> DataFrame:
    """Rows whose key is not among the doomed."""
    marks = doomed.select(*key).distinct()
    match = F.lit(True)
    for c in key:
        match = match & df[c].eqNullSafe(marks[c])
    return df.join(marks, match, "left_anti")


def removed(df: DataFrame, doomed: DataFrame, key: Sequence[str]) -> DataFrame:
    """The keys that ``deleted`` takes away."""
    return df.join(doomed.select(*key).distinct(), list(key), "left_semi").select(*key).distinct()


def updated_from(df: DataFrame, rows: DataFrame, key: Sequence[str], overwrite: bool = True, where: Column | None = None) -> DataFrame:
    """UPDATE … FROM: the other columns of rows replace those of the rows with their key.

    Without ``overwrite`` a null leaves the old value (COALESCE). ``where`` (over the old columns)
    guards the update.
    """
    new = [c for c in rows.columns if c not in key]
    marked = one_per_key(rows, key).select(*key, *[F.col(c).alias(f"__new_{c}") for c in new], F.lit(True).alias("__hit"))
    joined = df.join(marked, list(key), "left")
    hit = F.coalesce(F.col("__hit") & (where if where is not None else F.lit(True)), F.lit(False))
    value = lambda c: F.col(f"__new_{c}") if overwrite else F.coalesce(f"__new_{c}", c)
    return joined.select(*[F.when(hit, value(c)).otherwise(F.col(c)).cast(df.schema[c].dataType).alias(c) if c in new else F.col(c) for c in df.columns])


def updated_where(df: DataFrame, where: Column, **values: Column) -> DataFrame:
    """UPDATE … SET … WHERE with expressions."""
    hit = F.coalesce(where, F.lit(False))
    return df.select(*[F.when(hit, values[c]).otherwise(F.col(c)).cast(df.schema[c].dataType).alias(c) if c in values else F.col(c) for c in df.columns])


def restored(pages: DataFrame, wanted: DataFrame, key: Sequence[str] = ("source_id", "slug")) -> DataFrame:
    """Pages with deleted_at cleared where the key is wanted."""
    marks = wanted.select(*key).distinct().withColumn("__back", F.lit(True))
    return pages.join(marks, list(key), "left").withColumn("deleted_at", F.when(F.col("__back").isNull(), F.col("deleted_at"))).select(*pages.columns)


def put_pages(pages: DataFrame, rows: DataFrame, timeline: DataFrame, day: str, keep: Sequence[str] = ()) -> tuple[DataFrame, DataFrame]:
    """(pages, timeline) after an upsert by (source_id, slug); each created page has an entry of its own in the timeline.

    ``rows`` holds source_id, slug and the columns to set; null never overwrites ``keep`` columns.
    Timeline rows are (source_id, slug, date, source, summary).
    """
    key = ["source_id", "slug"]
    rows = one_per_key(rows, key)
    made = rows.join(pages.select(*key).distinct(), key, "left_anti").select(*key, F.lit(day).cast("date").alias("date"), F.lit("system").alias("source"), F.lit("page created").alias("summary"))
    return upserted(pages, rows, key, keep), insert_ignore(timeline, made, ["source_id", "slug", "date", "source", "summary"])


def put_chunks(stored: DataFrame, made: DataFrame, pages: DataFrame) -> DataFrame:
    """Chunks after those of ``pages`` (page_id) are made anew.

    Indexes that are no more made vanish. A chunk whose text stayed keeps its vector unless the new
    row brings one, and the newer embedded_at; a changed text loses them. Both tables have page_id,
    chunk_index, chunk_text, embedding, embedded_at.
    """
    key = ["page_id", "chunk_index"]
    touched = stored.join(pages.select("page_id").distinct(), "page_id", "left_semi")
    others = stored.join(pages.select("page_id").distinct(), "page_id", "left_anti")
    old = touched.select(*key, F.col("chunk_text").alias("__t"), F.col("embedding").alias("__e"), F.col("embedded_at").alias("__at"))
    same = F.col("chunk_text").eqNullSafe(F.col("__t"))
    joined = made.join(old, key, "left")
    return others.select(*made.columns).union(
        joined.select(*[
            F.when(same, F.coalesce("embedding", "__e")).otherwise(F.col("embedding")).alias(c) if c == "embedding"
            else F.when(same, F.greatest("embedded_at", "__at")).otherwise(F.col("embedded_at")).alias(c) if c == "embedded_at" else F.col(c)
            for c in made.columns
        ])
    )


def invalidated(chunks: DataFrame, signature: str) -> DataFrame:
    """Chunks whose vectors of another model than ``signature`` are null."""
    stale = ~F.col("model").eqNullSafe(signature)
    return updated_where(chunks, stale, embedding=F.lit(None), embedded_at=F.lit(None))


def put_links(links: DataFrame, rows: DataFrame, pages: DataFrame) -> DataFrame:
    """(src, dst, link_type, link_source, origin): edges given by slugs, with both ends resolved, added to links.

    ``rows``: from_slug, to_slug, origin_slug, source_id, link_type, link_source. Edges with an end
    that is no page are left out, an unknown origin is null; edges that links holds stay as they are.
    """
    slugs = pages.select("id", "slug", "source_id").distinct()
    end = lambda name, out: slugs.select(F.col("id").alias(out), F.col("slug").alias(name), "source_id")
    found = rows.join(end("from_slug", "src"), ["from_slug", "source_id"]).join(end("to_slug", "dst"), ["to_slug", "source_id"])
    found = found.join(end("origin_slug", "origin"), ["origin_slug", "source_id"], "left").select("src", "dst", "link_type", "link_source", "origin")
    return insert_ignore(links, found, ["src", "dst", "link_type", "link_source", "origin"])


def repointed(df: DataFrame, moves: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows with the given id columns moved from ``old`` to ``new``."""
    once = moves.groupBy("old").agg(F.min("new").alias("new"))
    for n, c in enumerate(columns):
        step = once.select(F.col("old").alias(f"__old{n}"), F.col("new").alias(f"__new{n}"))
        df = df.join(step, F.col(c) == F.col(f"__old{n}"), "left").withColumn(c, F.coalesce(f"__new{n}", c)).drop(f"__old{n}", f"__new{n}")
    return df


def superseded(claims: DataFrame, rows: DataFrame) -> DataFrame:
    """Claims after each (page_id, old_row, claim, weight) of rows replaced an active, unresolved claim.

    The old row becomes inactive and names its successor, which has the page's next row number (in
    the order of the old rows). Resolved or unknown rows are left alone.
    """
    open_rows = claims.where("active AND quality IS NULL").select("page_id", F.col("row_num").alias("old_row"))
    taken = one_per_key(rows, ["page_id", "old_row"]).join(open_rows, ["page_id", "old_row"])
    last = claims.join(taken.select("page_id").distinct(), "page_id", "left_semi").groupBy("page_id").agg(F.max("row_num").alias("last"))
    numbered = taken.join(last, "page_id").withColumn("row", (F.col("last") + F.row_number().over(Window.partitionBy("page_id").orderBy("old_row"))).cast("int"))
    closed = claims.join(numbered.select("page_id", F.col("old_row").alias("row_num"), "row"), ["page_id", "row_num"], "left")
    old = closed.select("page_id", "row_num", "claim", "weight", (F.col("active") & F.col("row").isNull()).alias("active"), "quality", F.col("row").alias("superseded_by"))
    new = numbered.select("page_id", F.col("row").alias("row_num"), "claim", "weight", F.lit(True).alias("active"), F.lit(None).cast("string").alias("quality"), F.lit(None).cast("int").alias("superseded_by"))
    return old.union(new)


def inserted_facts(facts: DataFrame, rows: DataFrame, at: str) -> DataFrame:
    """Facts with new ones appended; a new fact that names ``supersedes`` expires that one, which points to it.

    Both have id, fact, valid_from, expired_at, superseded_by; rows has supersedes besides. An expired
    fact is not expired again.
    """
    ends = rows.where("supersedes IS NOT NULL").groupBy(F.col("supersedes").alias("id")).agg(F.min("id").alias("__by"))
    hit = F.col("__by").isNotNull() & F.col("expired_at").isNull()
    old = facts.join(ends, "id", "left").select(
        *[F.when(hit, F.lit(at).cast(facts.schema[c].dataType)).otherwise(F.col(c)).alias(c) if c == "expired_at"
          else F.when(hit, F.col("__by")).otherwise(F.col(c)).alias(c) if c == "superseded_by" else F.col(c) for c in facts.columns]
    )
    return old.unionByName(rows.select(*[F.col(c) if c in rows.columns else F.lit(None).cast(facts.schema[c].dataType).alias(c) for c in facts.columns]))


def snapshots(pages: DataFrame, at: str) -> DataFrame:
    """(page_id, compiled_truth, frontmatter, snapshot_at): versions of pages."""
    return pages.select(F.col("id").alias("page_id"), "compiled_truth", "frontmatter", F.lit(at).cast("timestamp_ntz").alias("snapshot_at")).distinct()


def reverted(pages: DataFrame, versions: DataFrame) -> DataFrame:
    """Pages set back to one version each (page_id, compiled_truth, frontmatter, snapshot_at): the latest given."""
    last = versions.groupBy(F.col("page_id").alias("id")).agg(F.max_by(F.struct("compiled_truth", "frontmatter"), "snapshot_at").alias("v"))
    return updated_from(pages, last.select("id", "v.*"), ["id"])


def replaced(df: DataFrame, rows: DataFrame, key: Sequence[str]) -> DataFrame:
    """All rows of the keys of ``rows`` are replaced by these."""
    return deleted(df, rows, key).unionByName(rows.distinct())


def merged_json(column: Column, patch: Mapping[str, str | None]) -> Column:
    """A flat JSON object with the patch merged in: a null drops its key, other values replace or add theirs."""
    old = F.coalesce(F.from_json(column, "map<string,string>"), F.create_map().cast("map<string,string>"))
    kept = F.map_filter(old, lambda k, v: ~k.isin(list(patch)))
    added = [x for k, v in patch.items() if v is not None for x in (F.lit(k), F.lit(v))]
    return F.to_json(F.map_concat(kept, F.create_map(*added)) if added else kept)


def added_counts(totals: DataFrame, rows: DataFrame, key: Sequence[str], sums: Sequence[str]) -> DataFrame:
    """Additive upsert: new counts are summed by key and added to the totals."""
    both = totals.select(*key, *sums).unionByName(rows.select(*key, *sums))
    return both.groupBy(*key).agg(*[F.sum(c).alias(c) for c in sums])


def kept_since(df: DataFrame, column: str, moment: str) -> DataFrame:
    """Retention: rows from a moment on, and those without one."""
    return df.where(F.col(column).isNull() | (F.col(column) >= F.lit(moment).cast(df.schema[column].dataType)))


def numbered(df: DataFrame, rows: DataFrame, key: str, order: Sequence[str]) -> DataFrame:
    """Rows appended with ids that go on from the greatest one, given range by range, not in one task."""
    from ..session import materialize

    placed = materialize(rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("__part", F.spark_partition_id()).withColumn("__at", F.monotonically_increasing_id()))
    sizes = placed.groupBy("__part").agg(F.count("*").alias("n"), F.min("__at").alias("low"))
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)  # one row a partition
    starts = sizes.select("__part", "low", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    top = df.agg(F.coalesce(F.max(key), F.lit(0)).alias("top"))
    made = placed.join(starts, "__part").crossJoin(top)  # one row
    made = made.withColumn(key, (F.col("top") + F.col("start") + F.col("__at") - F.col("low") + 1).cast(df.schema[key].dataType))
    return df.unionByName(made.select(*df.columns))


def typed_by_prefix(pages: DataFrame, rules: Mapping[str, str]) -> DataFrame:
    """Untyped pages get the type of the longest prefix that their slug has."""
    kind = F.lit(None).cast("string")
    for prefix in sorted(rules, key=len):
        kind = F.when(F.col("slug").startswith(prefix), F.lit(rules[prefix])).otherwise(kind)
    return updated_where(pages, F.col("type").isNull() & kind.isNotNull(), type=kind)


def generation_bumped(before: DataFrame, after: DataFrame, key: str, columns: Sequence[str], generation: str = "generation") -> DataFrame:
    """after with the generation of each row whose content changed one higher; new rows begin at 1."""
    mark = F.xxhash64(*columns)
    old = before.select(F.col(key), mark.alias("__mark"), F.col(generation).alias("__gen"))
    bumped = F.when(F.col("__mark").isNull(), F.lit(1)).when(F.col("__mark") != mark, F.col("__gen") + 1).otherwise(F.col("__gen"))
    return after.drop(generation).join(old, key, "left").withColumn(generation, bumped).drop("__mark", "__gen")
