"""The named operations: each reads or changes a store, a set of tables held as DataFrames.

A store is a value. Reading operations return a DataFrame, writing ones a new store whose tables are
plans over the old ones; ``save`` writes those that changed. Parameters are checked by name before any
plan is made, and limits are clamped as in listings (20 by default, 100 at most).
"""

from __future__ import annotations

import inspect
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import extensions, packs
from .functions import scores, strings, text
from .operators import fulltext, graph, hybrid, measures, pages as page_ops, search, series, walks, writes
from .operators.hierarchy import descendants, hierarchy
from .plans.derived import VIEWS, derived
from .sources.tables import table

OPERATIONS: dict[str, Operation] = {}
_TABLES = ("pages", "content_chunks", "links", "timeline_entries", "minion_jobs", "sources", "events", "documents", "embeddings")


class Store:
    """Tables by name; those of a folder are read when they are first asked for."""

    def __init__(self, spark: SparkSession, folder: str | None = None, tables: dict[str, DataFrame] | None = None, changed: frozenset[str] = frozenset()):
        self.spark, self.folder, self.tables, self.changed = spark, folder, dict(tables or {}), changed

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self.tables:
            if name in VIEWS and self.folder:
                self.tables[name] = derived(self.spark, self.folder, name)
            elif name in _TABLES and self.folder:
                self.tables[name] = table(self.spark, self.folder, name)
            elif name == "tags":
                found = F.from_json(F.get_json_object("frontmatter", "$.tags"), "array<string>")
                self.tables[name] = self["pages"].select(F.col("id").alias("page_id"), F.explode(found).alias("tag")).distinct()
            elif name in _EMPTY:
                self.tables[name] = self.spark.createDataFrame([], _EMPTY[name])
            else:
                raise KeyError(f"no table {name}")
        return self.tables[name]

    def having(self, **tables: DataFrame) -> Store:
        """The store with some tables in a new state."""
        return Store(self.spark, self.folder, self.tables | tables, self.changed | set(tables))

    def run(self, name: str, /, **params):
        """The result of a named operation."""
        if name not in OPERATIONS:
            raise ValueError(f"no operation {name}")
        return OPERATIONS[name](self, **params)

    def save(self, folder: str) -> None:
        """Write the tables that changed."""
        for name in sorted(self.changed):
            self.tables[name].write.mode("overwrite").parquet(f"{folder}/{name}.parquet")


#: Schemas of tables that begin empty.
_EMPTY = {
    "page_versions": "page_id int, compiled_truth string, frontmatter string, snapshot_at timestamp_ntz", "raw_data": "page_id int, source string, data string",
    "ingest_log": "id bigint, source_id string, summary string, created_at timestamp_ntz", "config": "key string, value string", "aliases": "page_id int, alias string",
}


@dataclass
class Operation:
    """A named operation with its parameters."""

    name: str
    kind: str
    call: Callable

    def __call__(self, store: Store, **params):
        known = inspect.signature(self.call).parameters
        wrong = set(params) - set(known)
        missing = {n for n, p in list(known.items())[1:] if p.default is p.empty} - set(params)
        if wrong or missing:
            raise ValueError(f"{self.name}: unknown parameters {sorted(wrong)}, missing {sorted(missing)}")
        return self.call(store, **params)


def operation(kind: str) -> Callable:
    def add(f: Callable) -> Callable:
        OPERATIONS[f.__name__] = Operation(f.__name__, kind, f)
        return f

    return add


def _limit(n: int, most: int = 100) -> int:
    return min(max(n, 1), most)


def _pages(store: Store, *columns: str) -> DataFrame:
    return store["pages"].select("id", "source_id", "slug", "deleted_at", *columns).distinct()


def _at(slug: str, source_id: str) -> Column:
    return (F.col("slug") == slug.lower()) & (F.col("source_id") == source_id)


def _id_of(store: Store, slug: str, source_id: str) -> DataFrame:
    """(page_id), one row at most."""
    return store["pages"].where(_at(slug, source_id)).select(F.col("id").alias("page_id")).distinct()


# --- pages ------------------------------------------------------------------------------------------


@operation("read")
def get_page(store: Store, slug: str, source_id: str = "default", deleted: bool = False) -> DataFrame:
    """One page by its key; soft-deleted ones only if asked for."""
    rows = _pages(store, "type", "title", "compiled_truth", "timeline", "frontmatter").where(_at(slug, source_id))
    return rows if deleted else rows.where("deleted_at IS NULL")


@operation("write")
def put_page(store: Store, slug: str, title: str, body: str, kind: str = "note", source_id: str = "default", now: str = "2026-01-01 00:00:00") -> Store:
    """A page by its key, with a version of what stood there before; a new page has an entry in its timeline."""
    pages = store["pages"].distinct()
    before = pages.where(_at(slug, source_id))
    row = store.spark.range(1).select(
        F.lit(source_id).alias("source_id"), F.lit(slug.lower()).alias("slug"), F.lit(title).alias("title"), F.lit(body).alias("compiled_truth"), F.lit(kind).alias("type"),
        F.sha2(F.lit(body), 256).alias("content_hash"), F.to_timestamp_ntz(F.lit(now)).alias("updated_at"),
    )
    after = page_ops.upserted(pages, row, ["source_id", "slug"])
    top = pages.agg(F.coalesce(F.max("id"), F.lit(0)).alias("top"))
    after = after.crossJoin(top).withColumn("id", F.coalesce("id", (F.col("top") + 1).cast("int"))).drop("top")  # one row
    made = after.where(_at(slug, source_id)).join(before.select("id"), "id", "left_anti")
    entry = made.select(F.lit(None).cast("int").alias("id"), F.col("id").alias("page_id"), F.to_date(F.lit(now)).alias("date"), F.lit("system").alias("source"), F.lit("page created").alias("summary"))
    timeline = store["timeline_entries"].unionByName(entry, allowMissingColumns=True)
    return store.having(pages=after, timeline_entries=timeline, page_versions=store["page_versions"].unionByName(writes.snapshots(before, now)))


@operation("write")
def delete_page(store: Store, slug: str, source_id: str = "default", now: str = "2026-01-01 00:00:00") -> Store:
    pages = store["pages"]
    return store.having(pages=page_ops.soft_deleted(pages, pages.where(_at(slug, source_id)), now))


@operation("write")
def restore_page(store: Store, slug: str, source_id: str = "default") -> Store:
    return store.having(pages=writes.restored(store["pages"], store["pages"].where(_at(slug, source_id))))


@operation("write")
def purge_deleted_pages(store: Store, before: str) -> Store:
    """Pages deleted before a moment leave, with their chunks and links."""
    kept = page_ops.purged(store["pages"], before)
    gone = writes.deleted(store["pages"].select("id"), kept, ["id"]).select(F.col("id").alias("page_id")).distinct()
    chunks = writes.deleted(store["content_chunks"], gone, ["page_id"])
    links = writes.deleted(writes.deleted(store["links"], gone.toDF("from_page_id"), ["from_page_id"]), gone.toDF("to_page_id"), ["to_page_id"])
    return store.having(pages=kept, content_chunks=chunks, links=links)


@operation("read")
def list_pages(store: Store, types: list[str] | None = None, tag: str | None = None, updated_after: str | None = None, prefix: str | None = None, sources: list[str] | None = None, order: str = "updated_desc", limit: int = 20, offset: int = 0) -> DataFrame:
    """A page of the listing, by type, tag, date, prefix and sources."""
    rows = _pages(store, "type", "title", "updated_at", "created_at").where("deleted_at IS NULL")
    if tag is not None:
        rows = rows.join(store["tags"].where(F.col("tag") == tag).select(F.col("page_id").alias("id")), "id", "left_semi")
    if sources:
        rows = rows.where(F.col("source_id").isin(sources))
    return page_ops.listed(rows, types, updated_after, prefix, order=order, limit=limit, offset=offset).select("id", "source_id", "slug", "type", "title")


@operation("read")
def resolve_slugs(store: Store, names: list[str]) -> DataFrame:
    """(name, id, how): the page of each name."""
    return walks.resolved(store.spark.createDataFrame([(n,) for n in names], "name string"), store["pages"].where("deleted_at IS NULL"))


@operation("read")
def get_chunks(store: Store, slug: str, source_id: str = "default", vectors: bool = False) -> DataFrame:
    """A page's chunks in order, with their vectors if asked for."""
    columns = ["id", "page_id", "chunk_index", "chunk_text", "chunk_source", *(["embedding"] if vectors else [])]
    rows = store["content_chunks"].select(*columns).join(_id_of(store, slug, source_id), "page_id", "left_semi")
    return rows.dropDuplicates(["id"]).orderBy("chunk_index", "id")


@operation("read")
def get_versions(store: Store, slug: str, source_id: str = "default") -> DataFrame:
    return store["page_versions"].join(_id_of(store, slug, source_id), "page_id", "left_semi").orderBy(F.desc("snapshot_at"))


@operation("write")
def revert_version(store: Store, slug: str, snapshot_at: str, source_id: str = "default", now: str = "2026-01-01 00:00:00") -> Store:
    """A page set back to one of its versions; what stood there becomes a version."""
    chosen = store["page_versions"].where(F.col("snapshot_at") == F.to_timestamp_ntz(F.lit(snapshot_at))).join(_id_of(store, slug, source_id), "page_id", "left_semi")
    before = store["pages"].where(_at(slug, source_id))
    return store.having(pages=writes.reverted(store["pages"], chosen), page_versions=store["page_versions"].unionByName(writes.snapshots(before, now)))


@operation("write")
def put_raw_data(store: Store, slug: str, source: str, data: str, source_id: str = "default") -> Store:
    row = _id_of(store, slug, source_id).select("page_id", F.lit(source).alias("source"), F.lit(data).alias("data"))
    return store.having(raw_data=page_ops.upserted(store["raw_data"], row, ["page_id", "source"]))


@operation("read")
def get_raw_data(store: Store, slug: str, source: str | None = None, source_id: str = "default") -> DataFrame:
    rows = store["raw_data"].join(_id_of(store, slug, source_id), "page_id", "left_semi")
    return rows.where(F.col("source") == source) if source else rows


# --- tags, links, timeline --------------------------------------------------------------------------


@operation("write")
def add_tag(store: Store, slug: str, tag: str, source_id: str = "default") -> Store:
    row = _id_of(store, slug, source_id).select("page_id", F.lit(tag).alias("tag"))
    return store.having(tags=page_ops.insert_ignore(store["tags"], row, ["page_id", "tag"]))


@operation("write")
def remove_tag(store: Store, slug: str, tag: str, source_id: str = "default") -> Store:
    row = _id_of(store, slug, source_id).select("page_id", F.lit(tag).alias("tag"))
    return store.having(tags=writes.deleted(store["tags"], row, ["page_id", "tag"]))


@operation("read")
def get_tags(store: Store, slug: str, source_id: str = "default") -> DataFrame:
    return store["tags"].join(_id_of(store, slug, source_id), "page_id", "left_semi").select("tag").distinct().orderBy("tag")


@operation("write")
def add_link(store: Store, src: str, dst: str, link_type: str = "mentions", link_source: str = "manual", context: str = "", source_id: str = "default") -> Store:
    """A typed edge between two pages; one that is there stays as it is."""
    ends = _id_of(store, src, source_id).toDF("from_page_id").crossJoin(_id_of(store, dst, source_id).toDF("to_page_id"))  # one row each
    row = ends.select("from_page_id", "to_page_id", F.lit(link_type).alias("link_type"), F.lit(link_source).alias("link_source"), F.lit(context).alias("context"))
    return store.having(links=page_ops.insert_ignore(store["links"], row, ["from_page_id", "to_page_id", "link_type", "link_source"]))


@operation("write")
def remove_link(store: Store, src: str, dst: str, link_type: str | None = None, source_id: str = "default") -> Store:
    ends = _id_of(store, src, source_id).toDF("from_page_id").crossJoin(_id_of(store, dst, source_id).toDF("to_page_id"))  # one row each
    key = ["from_page_id", "to_page_id", *(["link_type"] if link_type else [])]
    return store.having(links=writes.deleted(store["links"], ends.withColumn("link_type", F.lit(link_type)), key))


def _linked(store: Store, slug: str, source_id: str, here: str, there: str, link_type: str | None) -> DataFrame:
    rows = store["links"].select(here, there, "link_type", "link_source", "context").distinct()
    if link_type:
        rows = rows.where(F.col("link_type") == link_type)
    rows = rows.join(_id_of(store, slug, source_id).toDF(here), here, "left_semi")
    other = store["pages"].select(F.col("id").alias(there), "slug").distinct()
    return rows.join(other, there).select("slug", "link_type", "link_source", "context")


@operation("read")
def get_links(store: Store, slug: str, source_id: str = "default", link_type: str | None = None) -> DataFrame:
    return _linked(store, slug, source_id, "from_page_id", "to_page_id", link_type)


@operation("read")
def get_backlinks(store: Store, slug: str, source_id: str = "default", link_type: str | None = None) -> DataFrame:
    return _linked(store, slug, source_id, "to_page_id", "from_page_id", link_type)


@operation("read")
def list_link_sources(store: Store) -> DataFrame:
    return graph.edges(store["links"]).groupBy("link_source").agg(F.count("*").alias("links")).orderBy(F.desc("links"), F.asc_nulls_last("link_source"))


@operation("read")
def traverse_graph(store: Store, slug: str, source_id: str = "default", depth: int = 5, link_type: str | None = None, way: str = "out", fan: int | None = None) -> DataFrame:
    """(seed, node, depth, path) from a page along its links, against them or both."""
    edges = graph.edges(store["links"])
    if link_type:
        edges = edges.where(F.col("link_type") == link_type)
    both = walks.both_ways(edges.select("src", "dst").distinct())
    chosen = both if way == "both" else both.where(F.col("way") == way)
    return walks.paths(_id_of(store, slug, source_id).toDF("id"), chosen.select("src", "dst"), depth, fan)


@operation("write")
def add_timeline_entry(store: Store, slug: str, date: str, summary: str, source: str = "", source_id: str = "default") -> Store:
    row = _id_of(store, slug, source_id).select("page_id", F.to_date(F.lit(date)).alias("date"), F.lit(source).alias("source"), F.lit(summary).alias("summary"))
    return store.having(timeline_entries=page_ops.insert_ignore(store["timeline_entries"], row, ["page_id", "date", "source", "summary"]))


@operation("read")
def get_timeline(store: Store, slug: str, source_id: str = "default", since: str | None = None, until: str | None = None, limit: int = 100) -> DataFrame:
    rows = store["timeline_entries"].select("page_id", "date", "source", "summary").join(_id_of(store, slug, source_id), "page_id", "left_semi").distinct()
    if since:
        rows = rows.where(F.col("date") >= F.to_date(F.lit(since)))
    if until:
        rows = rows.where(F.col("date") <= F.to_date(F.lit(until)))
    return rows.orderBy(F.desc("date"), "summary", "source").limit(_limit(limit, 1000))


# --- search -----------------------------------------------------------------------------------------


def _live(store: Store) -> DataFrame:
    return page_ops.visible(store["pages"], store["sources"]).select("id", "slug", "type").distinct()


def _texts(store: Store) -> DataFrame:
    return store["content_chunks"].select("id", "page_id", "chunk_text", "chunk_source").distinct()


@operation("read")
def search_pages(store: Store, text: str, limit: int = 20, detail: str = "medium") -> DataFrame:
    """Keyword search: the best chunk of each page."""
    return hybrid.keyword_arm(_texts(store), _live(store), text, _limit(limit), detail).select("page_id", "chunk_id", "score", "rank")


OPERATIONS["search"] = Operation("search", "read", search_pages)


@operation("read")
def query(store: Store, text: str, vector: list[float] | None = None, limit: int = 20, detail: str = "medium") -> DataFrame:
    """Hybrid search: a keyword arm, and a vector arm where a query vector is given, fused and rescored."""
    live = _live(store)
    arms = [hybrid.keyword_arm(_texts(store), live, text, 60, detail)]
    if vector:
        chunks = store["content_chunks"].select("id", "page_id", "chunk_source", "embedding").dropDuplicates(["id"])
        arms.append(hybrid.vector_arm(chunks, live, vector, 60, detail))
    rows = hybrid.fused(arms, detail=detail)
    if vector:
        rows = hybrid.rescored(rows, arms[1])
    return search.ranked(rows, _limit(limit), "page_id")


@operation("read")
def find_experts(store: Store, topic: str, limit: int = 10, now: str = "2026-01-01 00:00:00") -> DataFrame:
    """People whose pages answer a topic, by match, age and salience."""
    people = page_ops.visible(store["pages"], store["sources"]).where("type = 'person'")
    hits = fulltext.search(people.select("id", "title", "compiled_truth", "updated_at", "created_at", "emotional_weight").distinct(), topic, {"title": "A", "compiled_truth": "B"})
    age = F.greatest(scores.age_days(F.coalesce("updated_at", "created_at"), now), F.lit(0.0))
    weight = F.coalesce(F.col("emotional_weight").cast("double"), F.lit(1.0))
    score = F.log1p("rank") * F.greatest(F.lit(0.1), F.exp(-age / 180)) * (0.5 + 0.5 * weight / (1 + weight))
    return hits.select("id", score.alias("score")).orderBy(F.desc("score"), "id").limit(_limit(limit))


@operation("read")
def volunteer_context(store: Store, turns: list[str], most: int = 3) -> DataFrame:
    """(id, turn): pages whose titles the last turns of a talk name, the latest turn first."""
    names = store["pages"].where("title IS NOT NULL AND deleted_at IS NULL").select("id", "title").distinct()
    said = store.spark.createDataFrame([(-i - 1, t) for i, t in enumerate(turns)], "id int, said string")
    met = walks.mentions(said, names, body="said")
    return met.groupBy(F.col("target").alias("id")).agg(F.min("id").alias("turn")).orderBy("turn", "id").limit(most)


# --- claims and facts -------------------------------------------------------------------------------


@operation("read")
def takes_list(store: Store, holder: str | None = None, active: bool | None = None, resolved: bool | None = None, order: str = "newest", limit: int = 100) -> DataFrame:
    """Claims by holder and state; an option that is not given does not count."""
    rows = store["claims"]
    if holder is not None:
        rows = rows.where(F.col("holder") == holder)
    if active is not None:
        rows = rows.where(F.col("active") == active)
    if resolved is not None:
        rows = rows.where(F.col("quality").isNotNull() == resolved)
    by = {"newest": F.desc_nulls_last("since_date"), "weight": F.desc_nulls_last("weight")}[order]
    return rows.orderBy(by, "id").limit(_limit(limit)).select("id", "page_id", "row_num", F.date_format("since_date", "yyyy-MM").alias("since"), "weight")


@operation("read")
def takes_search(store: Store, words: str, holders: list[str] | None = None, least: float = 0.1, limit: int = 30) -> DataFrame:
    rows = store["claims"].where(F.col("holder").isin(holders)) if holders else store["claims"]
    rows = rows.withColumn("score", text.similarity(F.col("claim"), F.lit(words))).where(F.col("score") >= least)
    return rows.orderBy(F.desc("score"), "id").limit(_limit(limit)).select("id", "page_id", "score")


@operation("read")
def takes_scorecard(store: Store, by: list[str] | None = None) -> DataFrame:
    return measures.scorecard(store["claims"], by or ["holder"])


@operation("read")
def takes_calibration(store: Store, step: int = 10) -> DataFrame:
    """(bucket, n, predicted, observed): equal buckets of weights, the last with a weight of one."""
    rows = store["claims"].where(measures.OUTCOME(F.col("quality")).isNotNull()).withColumn("bucket", F.least(F.floor(F.col("weight") * step), F.lit(step - 1)).cast("int"))
    return rows.groupBy("bucket").agg(F.count("*").alias("n"), F.avg("weight").alias("predicted"), F.avg(measures.OUTCOME(F.col("quality"))).alias("observed"))


@operation("read")
def recall(store: Store, entity_id: int | None = None, session: str | None = None, since: str | None = None, limit: int = 50) -> DataFrame:
    """Open facts of an entity, a session or since a day, the newest first."""
    rows = store["facts"].where("expired_at IS NULL")
    if entity_id is not None:
        rows = rows.where(F.col("entity_id") == entity_id)
    if session is not None:
        rows = rows.where(F.col("session") == session)
    if since is not None:
        rows = rows.where(F.col("valid_from") >= F.to_date(F.lit(since)))
    return rows.orderBy(F.desc("valid_from"), "id").limit(_limit(limit)).select("id", "entity_id", "fact", "valid_from")


@operation("write")
def forget_fact(store: Store, fact_id: int, now: str = "2026-01-01 00:00:00") -> Store:
    """A fact expires; forgetting it again changes nothing."""
    hit = (F.col("id") == fact_id) & F.col("expired_at").isNull()
    return store.having(facts=writes.updated_where(store["facts"], hit, expired_at=F.to_timestamp_ntz(F.lit(now)), valid_until=F.to_date(F.lit(now))))


@operation("read")
def find_trajectory(store: Store, entity_id: int, metric: str | None = None) -> DataFrame:
    rows = store["facts"].where((F.col("entity_id") == entity_id) & F.col("metric").isNotNull())
    rows = rows.where(F.col("metric") == metric) if metric else rows
    return rows.select("metric", "valid_from", "amount", "id").orderBy("metric", "valid_from", "id")


@operation("read")
def find_contradictions(store: Store, every: int = 10) -> DataFrame:
    """(a, b): open claims of one page, of a stated set, that weigh the opposite way within a month."""
    rows = store["claims"].where((F.col("id") % every == 0) & F.col("active")).select("id", "page_id", "weight", "since_date")
    one, two = rows.toDF("a", "page_id", "w1", "d1"), rows.toDF("b", "page_id", "w2", "d2")
    return one.join(two, "page_id").where("a < b AND (w1 - 0.5) * (w2 - 0.5) < 0").where(F.abs(F.date_diff("d1", "d2")) <= 30).select("a", "b")


# --- reports ----------------------------------------------------------------------------------------


@operation("read")
def get_stats(store: Store) -> DataFrame:
    """(kind, n): counts of pages, chunks, links, tags and entries, and of pages by type."""
    parts = {
        "pages": _pages(store).where("deleted_at IS NULL"), "chunks": store["content_chunks"].select("id").distinct(), "links": graph.edges(store["links"]), "tags": store["tags"].select("tag").distinct(),
        "entries": store["timeline_entries"].select("page_id", "date", "source", "summary").distinct(),
    }
    rows = None
    for kind, df in parts.items():
        part = df.select(F.lit(kind).alias("kind"))
        rows = part if rows is None else rows.union(part)
    rows = rows.union(_pages(store, "type").select(F.concat(F.lit("type "), F.coalesce("type", F.lit("none")))))
    return rows.groupBy("kind").agg(F.count("*").alias("n"))


@operation("read")
def find_orphans(store: Store) -> DataFrame:
    return graph.orphans(store["pages"], store["links"])


@operation("read")
def get_recent_salience(store: Store, limit: int = 20) -> DataFrame:
    """Pages by emotional weight and the number of their claims."""
    claims = store["claims"].groupBy(F.col("page_id").alias("id")).agg(F.countDistinct("row_num").alias("n"))
    rows = _pages(store, "emotional_weight").where("deleted_at IS NULL").join(claims, "id", "left")
    score = F.coalesce(F.col("emotional_weight").cast("double"), F.lit(0.0)) * 5 + F.log1p(F.coalesce("n", F.lit(0)).cast("double"))
    return rows.select("id", score.alias("salience")).orderBy(F.desc("salience"), "id").limit(_limit(limit))


@operation("read")
def find_anomalies(store: Store, since: str, until: str, sigma: float = 3.0) -> DataFrame:
    """(cohort, day, n, mean, spread): days on which more entries of a source were made than usual."""
    rows = store["timeline_entries"].select("page_id", "source", "summary", F.col("date").alias("day")).distinct().where(F.col("day").between(F.to_date(F.lit(since)), F.to_date(F.lit(until))))
    counts = rows.groupBy(F.coalesce("source", F.lit("none")).alias("cohort"), "day").agg(F.count("*").alias("n"))
    return series.anomalies(series.gap_filled(counts, ["cohort"]), ["cohort"], sigma)


@operation("read")
def sources_list(store: Store, archived: bool = False) -> DataFrame:
    rows = store["sources"].select("id", "name", "local_path", "archived")
    return rows if archived else rows.where("NOT coalesce(archived, false)")


@operation("write")
def sources_add(store: Store, id: str, name: str, local_path: str | None = None) -> Store:
    row = store.spark.range(1).select(F.lit(id).alias("id"), F.lit(name).alias("name"), F.lit(local_path).cast("string").alias("local_path"), F.lit(False).alias("archived"))
    return store.having(sources=page_ops.insert_ignore(store["sources"], row, ["id"]))


@operation("write")
def sources_remove(store: Store, id: str, now: str = "2026-01-01 00:00:00") -> Store:
    """A source is archived; its pages are hidden with it."""
    hit = (F.col("id") == id) & ~F.coalesce("archived", F.lit(False))
    return store.having(sources=writes.updated_where(store["sources"], hit, archived=F.lit(True), archived_at=F.to_timestamp_ntz(F.lit(now))))


@operation("read")
def sources_status(store: Store) -> DataFrame:
    """(id, pages, newest): pages are counted by source before they meet the catalogue."""
    count = _pages(store, "updated_at").where("deleted_at IS NULL").groupBy(F.col("source_id").alias("id")).agg(F.count("*").alias("pages"), F.max("updated_at").alias("newest"))
    return store["sources"].select("id").join(count, "id", "left").select("id", F.coalesce("pages", F.lit(0)).alias("pages"), "newest")


@operation("write")
def log_ingest(store: Store, source_id: str, summary: str, now: str = "2026-01-01 00:00:00") -> Store:
    top = store["ingest_log"].agg((F.coalesce(F.max("id"), F.lit(0)) + 1).alias("id"))
    row = top.select("id", F.lit(source_id).alias("source_id"), F.lit(summary).alias("summary"), F.to_timestamp_ntz(F.lit(now)).alias("created_at"))
    return store.having(ingest_log=store["ingest_log"].unionByName(row))


@operation("read")
def get_ingest_log(store: Store, limit: int = 20) -> DataFrame:
    return store["ingest_log"].orderBy(F.desc("created_at"), F.desc("id")).limit(_limit(limit))


@operation("read")
def file_list(store: Store, slug: str | None = None, limit: int = 100) -> DataFrame:
    rows = store["files"] if slug is None else store["files"].where(F.col("page_slug") == slug)
    return rows.select("source_id", "page_slug", "filename", "storage_path").orderBy("storage_path").limit(_limit(limit))


@operation("read")
def get_job(store: Store, job_id: int) -> DataFrame:
    """The latest snapshot of a job."""
    rows = store["minion_jobs"].where(F.col("id") == job_id)
    return rows.orderBy(F.desc_nulls_last("updated_at"), F.desc("status")).limit(1)


@operation("read")
def list_jobs(store: Store, status: str | None = None, queue: str | None = None, limit: int = 20) -> DataFrame:
    best = F.max_by(F.struct("status", "queue", "name", "priority", "created_at", "progress"), F.struct("updated_at", "status")).alias("j")
    rows = store["minion_jobs"].groupBy("id").agg(best).select("id", "j.*")
    for column, value in (("status", status), ("queue", queue)):
        rows = rows if value is None else rows.where(F.col(column) == value)
    return rows.orderBy(F.desc_nulls_last("created_at"), "id").limit(_limit(limit))


@operation("read")
def get_job_tree(store: Store, job_id: int) -> DataFrame:
    """(id): all descendants of a job, by nested-set ranges."""
    tree = hierarchy(store["minion_jobs"], "id", "parent_job_id")
    return descendants(tree, tree.where(F.col("id") == job_id)).select("id")


# --- code -------------------------------------------------------------------------------------------


def _calls(store: Store) -> DataFrame:
    """(src, dst, callee): calls between chunks; dst is null where no chunk defines the name."""
    code = store["content_chunks"].where("language IS NOT NULL").select("id", "chunk_text").distinct()
    found = code.select(F.col("id").alias("src"), F.explode(F.regexp_extract_all("chunk_text", F.lit(r"\b([A-Za-z_][A-Za-z0-9_]*)\("), 1)).alias("callee")).distinct()
    known = store["content_chunks"].where("symbol_name IS NOT NULL").groupBy(F.col("symbol_name").alias("callee")).agg(F.min("id").alias("dst"))
    return found.join(known, "callee", "left").select("src", "dst", "callee")


def _definitions(store: Store, symbol: str) -> DataFrame:
    return store["content_chunks"].where((F.col("symbol_name") == symbol) | (F.col("symbol_name_qualified") == symbol)).select("id", "symbol_type", "page_id").distinct()


@operation("read")
def code_def(store: Store, symbol: str) -> DataFrame:
    kind = F.expr("CASE symbol_type WHEN 'class' THEN 0 WHEN 'interface' THEN 1 WHEN 'function' THEN 2 WHEN 'method' THEN 3 ELSE 4 END")
    return _definitions(store, symbol).orderBy(kind, "id")


@operation("read")
def code_refs(store: Store, symbol: str) -> DataFrame:
    """Code chunks that hold a name."""
    rows = store["content_chunks"].where(F.col("language").isNotNull() & F.col("chunk_text").contains(symbol))
    return rows.select("id", "page_id", "language").distinct().orderBy("id")


@operation("read")
def code_callers(store: Store, symbol: str) -> DataFrame:
    return _calls(store).where((F.col("callee") == symbol) & ~F.col("src").eqNullSafe(F.col("dst"))).select(F.col("src").alias("id"), F.col("dst").isNotNull().alias("resolved")).distinct()


@operation("read")
def code_callees(store: Store, symbol: str) -> DataFrame:
    own = _definitions(store, symbol).select(F.col("id").alias("src"))
    return _calls(store).join(own, "src", "left_semi").where(F.col("callee") != symbol).select("callee", F.col("dst").alias("id")).distinct()


def _code_walk(store: Store, symbol: str, depth: int, back: bool) -> DataFrame:
    calls = _calls(store).where("dst IS NOT NULL AND src <> dst").withColumn("link_type", F.lit("calls"))
    edges = calls.select(F.col("dst").alias("src"), F.col("src").alias("dst"), "link_type") if back else calls.select("src", "dst", "link_type")
    met = walks.reach(_definitions(store, symbol).select("id"), edges, depth).groupBy(F.col("node").alias("id")).agg(F.min("hop").alias("depth"))
    return met.withColumn("confidence", F.round(1 / (1 + 0.3 * F.col("depth")), 6))


@operation("read")
def code_blast(store: Store, symbol: str, depth: int = 5) -> DataFrame:
    """What may change with a symbol: its callers, theirs, and so on."""
    return _code_walk(store, symbol, min(depth, 5), True)


@operation("read")
def code_flow(store: Store, symbol: str, depth: int = 8) -> DataFrame:
    """What a symbol sets going: its callees, theirs, and so on."""
    return _code_walk(store, symbol, min(depth, 8), False)


# --- schema -----------------------------------------------------------------------------------------


@operation("read")
def schema_stats(store: Store) -> DataFrame:
    rows = _pages(store, "type").where("deleted_at IS NULL")
    return rows.groupBy("source_id").agg(F.count("*").alias("pages"), F.count("type").alias("typed"), F.countDistinct("type").alias("types"))


@operation("read")
def schema_graph(store: Store) -> DataFrame:
    """(from_type, link_type, to_type, n): which types link to which."""
    kinds = store["pages"].select("id", "type").distinct()
    rows = graph.edges(store["links"]).join(kinds.toDF("src", "from_type"), "src").join(kinds.toDF("dst", "to_type"), "dst")
    return rows.groupBy("from_type", "link_type", "to_type").agg(F.count("*").alias("n"))


@operation("read")
def schema_explain_type(store: Store, kind: str) -> DataFrame:
    """(prefix, pages): under which prefixes the pages of a type stand."""
    rows = _pages(store, "type").where(F.col("type") == kind)
    return rows.groupBy(F.split_part("slug", F.lit("/"), F.lit(1)).alias("prefix")).agg(F.count("*").alias("pages")).orderBy(F.desc("pages"), "prefix")


@operation("read")
def schema_review_orphans(store: Store, limit: int = 100) -> DataFrame:
    """Pages whose type stands under no other page's prefix."""
    rows = _pages(store, "type").where("deleted_at IS NULL").withColumn("prefix", F.split_part("slug", F.lit("/"), F.lit(1)))
    alone = rows.groupBy("prefix", "type").agg(F.count("*").alias("n")).where("n = 1").select("prefix", "type")
    return rows.join(alone, ["prefix", "type"], "left_semi").orderBy("id").limit(_limit(limit)).select("id", "slug", "type")


@operation("read")
def schema_lint(store: Store) -> DataFrame:
    """(id, fault): pages without a type or title, or with a slug in another form than slugs have."""
    fault = F.when(F.col("type").isNull(), "no type").when(F.coalesce("title", F.lit("")) == "", "no title").when(~F.col("slug").rlike(r"^[a-z0-9._/-]+$"), "slug")
    return _pages(store, "type", "title").where("deleted_at IS NULL").select("id", fault.alias("fault")).where("fault IS NOT NULL")


@operation("read")
def code_languages(store: Store) -> DataFrame:
    """(language, files): files by the language of their ending."""
    return store["files"].select("storage_path", strings.language_of(F.col("storage_path")).alias("language")).distinct().groupBy("language").agg(F.count("*").alias("files"))


@operation("read")
def raw_sql(store: Store, statement: str, tables: list[str], args: dict | None = None) -> DataFrame:
    """A parameterised statement over named tables of the store."""
    return store.spark.sql(statement, args=args or {}, **{t: store[t] for t in tables})


# --- status, upkeep and packs -----------------------------------------------------------------------


@operation("read")
def get_identity(store: Store) -> DataFrame:
    """One row: pages, sources and the newest change."""
    rows = _pages(store, "updated_at").where("deleted_at IS NULL")
    return rows.agg(F.countDistinct("id").alias("pages"), F.countDistinct("source_id").alias("sources"), F.max("updated_at").alias("newest"))


@operation("read")
def get_status_snapshot(store: Store, now: str, days: int = 30) -> DataFrame:
    """(what, n): pages, sources not synced for some days, jobs by status."""
    pages = _pages(store).where("deleted_at IS NULL").select(F.lit("pages").alias("what"))
    behind = F.col("last_sync_at").isNull() | (F.col("last_sync_at") < F.to_timestamp_ntz(F.lit(now)) - F.expr(f"INTERVAL {days} DAY"))
    sources = store["sources"].where(~F.coalesce("archived", F.lit(False))).agg(F.count_if(behind).alias("n")).select(F.lit("sources behind").alias("what"), "n")
    jobs = store["minion_jobs"].groupBy("id").agg(F.max_by("status", F.struct("updated_at", "status")).alias("s")).select(F.concat(F.lit("jobs "), "s").alias("what"))
    return pages.union(jobs).groupBy("what").agg(F.count("*").alias("n")).union(sources)


@operation("read")
def run_doctor(store: Store) -> DataFrame:
    """(fault, n): what is amiss in the tables."""
    pages = store["pages"].select("id").distinct()
    hashes = store["pages"].where(F.col("compiled_truth").isNotNull() & ~F.lower("content_hash").eqNullSafe(F.sha2("compiled_truth", 256))).select("id").distinct()
    parts = {
        "unembedded chunks": store["content_chunks"].where("embedding IS NULL").select("id").distinct(), "stale hashes": hashes,
        "links to nowhere": graph.edges(store["links"]).join(pages.toDF("dst"), "dst", "left_anti"), "chunks of no page": store["content_chunks"].select("id", "page_id").distinct().join(pages.toDF("page_id"), "page_id", "left_anti"),
    }
    out = None
    for fault, df in parts.items():
        part = df.agg(F.count("*").alias("n")).select(F.lit(fault).alias("fault"), "n")
        out = part if out is None else out.union(part)
    return out


@operation("read")
def get_calibration_profile(store: Store, holder: str) -> DataFrame:
    return measures.scorecard(store["claims"].where(F.col("holder") == holder), ["domain"])


@operation("read")
def get_recent_transcripts(store: Store, since: str, limit: int = 20) -> DataFrame:
    rows = store["documents"].where(F.col("kind").isin("chat", "meeting") & (F.col("created_at") >= F.to_timestamp_ntz(F.lit(since))))
    return rows.orderBy(F.desc("created_at"), "doc_id").limit(_limit(limit)).select("doc_id", "title", "created_at", F.substring("text", 1, 240).alias("synopsis"))


@operation("read")
def extract_facts(store: Store, extract: Callable, kind: str | None = None) -> DataFrame:
    """(doc_id, kind, value): what a plugged-in extractor finds in the texts of a kind."""
    rows = store["documents"] if kind is None else store["documents"].where(F.col("kind") == kind)
    return extensions.extracted(rows.select("doc_id", "text"), "doc_id", "text", extract)


@operation("read")
def search_by_vector(store: Store, vector: list[float], column: str = "embedding", limit: int = 20) -> DataFrame:
    """Pages by their chunk nearest to a vector, in any vector column the chunks have."""
    chunks = store["content_chunks"]
    if column not in chunks.columns:
        raise ValueError(f"no vector column {column}")
    rows = chunks.select("id", "page_id", "chunk_source", F.col(column).alias("embedding")).dropDuplicates(["id"])
    return hybrid.vector_arm(rows, _live(store), vector, _limit(limit))


@operation("write")
def sync(store: Store, new: DataFrame, gone: DataFrame) -> Store:
    """A source after a change set: new pages are upserted by (source_id, slug), gone ones leave."""
    key = ["source_id", "slug"]
    return store.having(pages=page_ops.upserted(writes.deleted(store["pages"], gone, key), writes.one_per_key(new, key), key))


@operation("write")
def schema_apply(store: Store, pack: packs.Pack) -> Store:
    """Pages after a pack: types by any of its names become its own, untyped pages get that of their prefix."""
    kind = F.coalesce(pack.canonical(F.col("type")), pack.type_of(F.col("slug")))
    return store.having(pages=store["pages"].withColumn("type", kind))


@operation("read")
def get_pack(store: Store, pack: packs.Pack = packs.DEFAULT) -> DataFrame:
    """(type, prefix): the types of a pack with their prefixes."""
    return store.spark.createDataFrame([(t.name, p) for t in pack.types for p in t.prefixes], "type string, prefix string")


@operation("write")
def set_jobs(store: Store, ids: list[int], status: str, now: str = "2026-01-01 00:00:00") -> Store:
    """Some jobs get a status; older snapshots of them leave."""
    jobs = store["minion_jobs"]
    best = F.max_by(F.struct(*[c for c in jobs.columns if c != "id"]), F.struct("updated_at", "status")).alias("j")
    latest = jobs.groupBy("id").agg(best).select("id", "j.*").select(*jobs.columns)
    return store.having(minion_jobs=writes.updated_where(latest, F.col("id").isin(ids), status=F.lit(status), updated_at=F.to_timestamp_ntz(F.lit(now))))
