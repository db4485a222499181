"""Walks over edge tables, link extraction, and the resolution of names to pages.

Walks go breadth first in rounds of joins; each round's state is written to the shared folder. What a
round carries is one row a path (``paths``) or one row a node (``reach``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text
from ..session import materialize

# Words around a link that tell its type, in the order they are tried.
VERBS = (
    ("founded", r"\b(founded|co-founded|founder of)\b"), ("invested_in", r"\b(invested in|led the round|backed)\b"), ("advises", r"\b(advises|advisor to|board member)\b"),
    ("works_at", r"\b(works at|joined|employed by|head of)\b"),
)
# Fields of the front matter that hold links, and the types of these.
FIELDS = {"company": "works_at", "companies": "works_at", "founded": "founded", "investors": "invested_in", "attendees": "attended", "related": "related"}
# What calls reach out of a program, by words in their names.
SINKS = (("db", r"(query|execute|select|insert|sql)"), ("http", r"(fetch|request|http|get_url|post)"), ("file", r"(open|read|write|save|load)"), ("process", r"(spawn|exec|system|run)"))


def paths(seeds: DataFrame, edges: DataFrame, depth: int = 5, fan: int | None = None) -> DataFrame:
    """(seed, node, depth, path): all paths without repeated nodes from each seed, along edges (src, dst).

    ``fan`` bounds the steps taken from one path's end, the smallest nodes first; it is a parameter of
    the walk, and without it every path is listed.
    """
    step = edges.select("src", "dst").where("src <> dst").distinct()
    if fan is not None:
        step = step.withColumn("__n", F.row_number().over(Window.partitionBy("src").orderBy("dst"))).where(F.col("__n") <= fan).drop("__n")
    front = materialize(seeds.select(F.col("id").alias("seed")).distinct().select("seed", F.col("seed").alias("node"), F.lit(0).alias("depth"), F.array("seed").alias("path")))
    out = front
    for n in range(1, depth + 1):
        found = front.join(step, front["node"] == step["src"]).where(~F.array_contains("path", F.col("dst")))
        front = materialize(found.select("seed", F.col("dst").alias("node"), F.lit(n).alias("depth"), F.concat("path", F.array("dst")).alias("path")))
        out = out.union(front)
    return out


def reach(seeds: DataFrame, edges: DataFrame, depth: int = 3) -> DataFrame:
    """(seed, node, hop, last_types): nodes within some steps of each seed along edges (src, dst, link_type).

    hop is the least number of steps; last_types the distinct types of the edges that lead to the node
    in a step from any node met one hop before.
    """
    step = edges.select("src", "dst", "link_type").where("src <> dst").distinct()
    front = materialize(seeds.select(F.col("id").alias("seed")).distinct().select("seed", F.col("seed").alias("node"), F.lit(0).alias("hop"), F.expr("CAST(array() AS array<string>)").alias("last_types")))
    met = front
    for n in range(1, depth + 1):
        found = front.join(step, front["node"] == step["src"]).groupBy("seed", F.col("dst").alias("node")).agg(F.lit(n).alias("hop"), F.array_sort(F.collect_set("link_type")).alias("last_types"))
        front = materialize(found.join(met.select("seed", "node"), ["seed", "node"], "left_anti").select("seed", "node", "hop", "last_types"))
        met = met.union(front)
    return met


def both_ways(edges: DataFrame) -> DataFrame:
    """Edges and their reverses, so that an OR over both ends becomes an equi-join."""
    rest = [c for c in edges.columns if c not in ("src", "dst")]
    out = edges.withColumn("way", F.lit("out"))
    return out.unionByName(edges.select(F.col("dst").alias("src"), F.col("src").alias("dst"), *rest, F.lit("in").alias("way")))


def sink(name: Column) -> Column:
    """What a called name reaches, null for none."""
    out = F.when(F.lit(False), "")
    for kind, words in SINKS:
        out = out.when(F.lower(name).rlike(words), kind)
    return out


def typed(context: Column, role: Column | None = None) -> Column:
    """The type of a link by the words around it, else by the role of its page, else mentions."""
    out = F.when(F.lit(False), "")
    for kind, words in VERBS:
        out = out.when(F.lower(context).rlike(words), kind)
    if role is not None:
        out = out.when(role == "meeting", "attended").when(role == "company", "related")
    return out.otherwise("mentions")


def links_in(pages: DataFrame, key: str = "id", body: str = "compiled_truth") -> DataFrame:
    """(key, kind, target, link_type): the links in the bodies, outside code, by four notations.

    wiki: [[target]] and [[target|label]]; qualified: [[source:target]]; markdown: [label](target.md);
    bare: a slug of two segments with a known first one. The sentence around a link tells its type.
    """
    plain = text.without_code(F.col(body))
    wiki = F.transform(F.regexp_extract_all(plain, F.lit(r"([^.!?\n]*\[\[[^\]|\n]+(?:\|[^\]\n]*)?\]\][^.!?\n]*)"), 1), lambda s: F.struct(s.alias("s"), F.regexp_extract_all(s, F.lit(r"\[\[([^\]|\n]+)(?:\|[^\]\n]*)?\]\]"), 1).alias("t")))
    rest = F.regexp_replace(plain, r"\[\[[^\]\n]*\]\]", " ")
    mark = F.transform(F.regexp_extract_all(rest, F.lit(r"\[[^\]\n]*\]\(([^)\s]+)\.md\)"), 1), lambda t: F.struct(F.lit("").alias("s"), F.array(t).alias("t")))
    bare = F.transform(F.regexp_extract_all(F.regexp_replace(rest, r"\[[^\]\n]*\]\([^)]*\)", " "), F.lit(r"\b((?:people|companies|projects|concepts|meetings)/[a-z0-9][a-z0-9-]*)"), 1), lambda t: F.struct(F.lit("").alias("s"), F.array(t).alias("t")))
    each = lambda found, kind: pages.where(F.col(body).isNotNull()).select(key, F.explode(found).alias("f")).select(key, F.lit(kind).alias("kind"), "f.s", F.explode("f.t").alias("target"))
    out = each(wiki, "wiki").union(each(mark, "markdown")).union(each(bare, "bare"))
    kind = F.when((F.col("kind") == "wiki") & F.col("target").contains(":"), "qualified").otherwise(F.col("kind"))
    target = F.lower(F.trim(F.col("target")))
    return out.select(key, kind.alias("kind"), target.alias("target"), typed(F.col("s")).alias("link_type")).distinct()


def front_links(pages: DataFrame, key: str = "id") -> DataFrame:
    """(key, field, target, link_type): links in the fields of the front matter, single values or lists."""
    found = None
    for name, kind in FIELDS.items():
        raw = F.get_json_object("frontmatter", f"$.{name}")
        values = F.coalesce(F.from_json(raw, "array<string>"), F.array(raw))
        part = pages.where(raw.isNotNull()).select(key, F.lit(name).alias("field"), F.explode(values).alias("target"), F.lit(kind).alias("link_type"))
        found = part if found is None else found.union(part)
    return found.where("target IS NOT NULL AND target <> ''").distinct()


def mentions(pages: DataFrame, titles: DataFrame, key: str = "id", body: str = "compiled_truth", most: int = 4) -> DataFrame:
    """(key, target, at): pages' first mentions of titles (id, title) of up to ``most`` words, the longest match at each place.

    A dictionary join: the words of a body make runs of one to ``most`` words, distinct a page, and
    meet the titles by equality; a match inside a longer one at the same place is left out.
    """
    words = lambda c: F.regexp_extract_all(F.lower(c), F.lit(r"([\p{L}\p{N}]+)"), 1)
    names = titles.select(F.col("id").alias("target"), words(F.col("title")).alias("w")).where(F.size("w").between(1, most) & (F.length(F.array_join("w", "")) >= 4))
    names = names.groupBy(F.array_join("w", " ").alias("run")).agg(F.min("target").alias("target"), F.first(F.size("w")).alias("n"))
    rows = pages.where(F.col(body).isNotNull()).select(key, words(F.col(body)).alias("w"))
    runs = F.flatten(F.transform(F.sequence(F.lit(1), F.lit(most)), lambda n: F.transform(F.filter(F.sequence(F.lit(1), F.greatest(F.size("w") - n + 1, F.lit(1))), lambda i: i + n - 1 <= F.size("w")), lambda i: F.struct(i.alias("at"), F.array_join(F.slice("w", i, n), " ").alias("run")))))
    each = rows.where("size(w) > 0").select(key, F.explode(runs).alias("r")).groupBy(key, "r.run").agg(F.min("r.at").alias("at"))
    hit = each.join(names.hint("merge"), "run").where(F.col(key) != F.col("target"))
    best = hit.groupBy(key, "at").agg(F.max_by("target", "n").alias("target"))
    return best.groupBy(key, "target").agg(F.min("at").alias("at"))


def resolved(names: DataFrame, pages: DataFrame) -> DataFrame:
    """(name, id, how): each name's page: by its exact slug, else its title, else the last segment of slugs (the shortest), else a slug that begins with it.

    A cascade of equi-joins: each step is asked only for what the steps before did not find.
    """
    asked = names.select("name").distinct()
    key = lambda c: text.slugify(c)
    live = pages.select("id", "slug", "title").distinct()
    first = lambda df, on: df.groupBy(on.alias("k")).agg(F.min(F.struct(F.length("slug").alias("n"), "slug", "id")).alias("b"))
    steps = (
        ("slug", F.lower("name"), first(live, F.col("slug"))), ("title", key(F.col("name")), first(live.where("title IS NOT NULL"), key(F.col("title")))),
        ("basename", key(F.col("name")), first(live, F.element_at(F.split("slug", "/"), -1))), ("prefix", key(F.col("name")), first(live, F.regexp_extract(F.element_at(F.split("slug", "/"), -1), "^([a-z0-9]+-[a-z0-9]+)", 1))),
    )
    out, left = None, asked
    for how, of, index in steps:
        met = left.withColumn("k", of).join(index.where("k <> ''").hint("merge"), "k", "left")
        found = met.where("b IS NOT NULL").select("name", F.col("b.id").alias("id"), F.lit(how).alias("how"))
        out = found if out is None else out.union(found)
        left = met.where("b IS NULL").select("name")
    return out.union(left.select("name", F.lit(None).cast("int"), F.lit("none")))


def held_in(offsets: DataFrame, spans: DataFrame, key: str) -> DataFrame:
    """offsets (key, at) with the span (key, begin, end, id) that holds each: an interval join inside the key."""
    met = offsets.join(spans, key).where("at >= begin AND at < end")
    return met.groupBy(key, "at").agg(F.min("id").alias("id"))
