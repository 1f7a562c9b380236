"""Schemas that drift between files: versioned fingerprints, changes, migration steps and one consistent table."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from axonframe.plans import cut_lineage, discard, lookup_join

#: Share of the neurons holding both fields whose values must agree for a rename, as (numerator, denominator).
RENAME_SHARE = (4, 5)

_TYPES = (("STRING", "string"), ("BIGINT", "integer"), ("BOOLEAN", "boolean"), ("DECIMAL", "decimal"), ("DOUBLE", "decimal"), ("FLOAT", "decimal"), ("ARRAY", "array"), ("OBJECT", "object"))
_FIELD = "struct<name:string,kind:string>"
_CHANGE = "struct<old_name:string,col_name:string,old_kind:string,new_kind:string,change_kind:string>"


@dataclass(frozen=True)
class Drops:
    """Column names of a table of delivered lines."""

    file: str = "file_id"
    stream: str = "stream"
    order: str = "exported_at"
    seq: str = "seq"
    entity: str = "root_id"
    payload: str = "payload"


@dataclass(frozen=True)
class Target:
    """A column of the consistent table.

    ``names`` (letters and digits only, lower case) are those by which a field is known; ``kind`` is the type that values are cast to
    (string, bigint, double or array<string>); ``default`` is the value, as text, where the file lacks the field.
    """

    names: tuple[str, ...]
    kind: str = "string"
    default: str | None = None


def _type_name(kind: Column) -> Column:
    """The field type of a variant's schema."""
    return F.coalesce(*[F.when(kind.startswith(k), F.lit(t)) for k, t in _TYPES], F.lit("other"))


def parse_lines(drops: DataFrame, c: Drops = Drops()) -> DataFrame:
    """One row per line: ``file_id``, ``stream``, ``seq``, ``entity``, ``fields``.

    ``fields`` lists ``name``, ``kind`` and ``text`` of the fields that are not null; it is null for lines that are no JSON object (null, empty, cut off, lists, numbers).
    ``text`` keeps how a number is written, such as ``5.0``; the variant alone would not.
    """
    keys = [F.col(name).alias(to) for name, to in ((c.file, "file_id"), (c.stream, "stream"), (c.seq, "seq"), (c.entity, "entity"))]
    variants = F.expr(f"try_parse_json({c.payload})").try_cast("map<string,variant>")
    # both maps are arguments of one function, so each is made once a line
    both = F.map_zip_with(variants, F.from_json(c.payload, "map<string,string>"), lambda k, v, t: F.struct(F.schema_of_variant(v).alias("kind"), t.alias("text")))
    typed = lambda e: F.struct(e["key"].alias("name"), _type_name(e["value"]["kind"]).alias("kind"), e["value"]["text"].alias("text"))
    return drops.select(*keys, F.transform(F.filter(F.map_entries(both), lambda e: e["value"]["kind"] != "VOID"), typed).alias("fields"))


def field_types(lines: DataFrame) -> DataFrame:
    """The fields of each file, each with the type of most of its values (the first by name in a tie)."""
    values = lines.select("file_id", F.explode("fields").alias("f"))
    counts = values.groupBy("file_id", F.col("f.name").alias("name"), F.col("f.kind").alias("kind")).agg(F.count(F.lit(1)).alias("n"))
    return counts.groupBy("file_id", "name").agg(F.min_by("kind", F.struct(-F.col("n"), F.col("kind"))).alias("kind"))


def schema_versions(drops: DataFrame, lines: DataFrame, c: Drops = Drops()) -> DataFrame:
    """Each file with its schema: ``file_id``, ``stream``, ``version`` (its place in the stream), ``prev_id``, ``schema``, ``prev_schema``, ``fingerprint``,
    ``schema_no``.

    ``schema`` lists the fields, by name, with their majority types; the fingerprint is a hash of it, equal for files of equal schema. ``schema_no`` numbers
    the distinct schemas of a stream in the order in which they first appear. A file without a valid line has no fields.
    """
    files = drops.groupBy(F.col(c.file).alias("file_id")).agg(F.min(c.stream).alias("stream"), F.min(c.order).alias("at"))
    schemas = field_types(lines).groupBy("file_id").agg(F.array_sort(F.collect_list(F.struct("name", "kind"))).alias("schema"))
    files = files.join(schemas, "file_id", "left").withColumn("schema", F.coalesce("schema", F.expr(f"cast(array() as array<{_FIELD}>)")))
    text = F.array_join(F.transform("schema", lambda f: F.concat_ws(":", f["name"], f["kind"])), ",")
    w = Window.partitionBy("stream").orderBy("at", "file_id")
    files = files.select("file_id", "stream", F.row_number().over(w).alias("version"), F.lag("file_id").over(w).alias("prev_id"), "schema", F.lag("schema").over(w).alias("prev_schema"), F.md5(text).alias("fingerprint"))
    files = files.withColumn("first", F.min("version").over(Window.partitionBy("stream", "fingerprint")))
    return files.withColumn("schema_no", F.dense_rank().over(Window.partitionBy("stream").orderBy("first"))).drop("first")


def _names(fields: str | Column) -> Column:
    return F.transform(fields, lambda f: f["name"])


def _lacking(a: str, b: str) -> Column:
    """Fields of one schema whose names another lacks."""
    there = _names(b)
    return F.filter(a, lambda f: ~F.array_contains(there, f["name"]))


def _renames(lines: DataFrame, steps: DataFrame) -> DataFrame:
    """``file_id``, ``pairs``: for each step, the gone fields with the new fields that they became.

    Only the lines of files where fields are both gone and new are read, and of them only these fields.
    """
    both = steps.where("size(gone) > 0 and size(come) > 0")
    ends = both.select(F.col("file_id").alias("step"), F.explode(F.array(F.struct(F.col("prev_id").alias("file_id"), _names("gone").alias("names")), F.struct("file_id", _names("come").alias("names")))).alias("e")).select("e.*")
    wanted = cut_lineage(ends.groupBy("file_id").agg(F.array_distinct(F.flatten(F.collect_list("names"))).alias("wanted")))
    values = lookup_join(lines.where("entity is not null").select("file_id", "entity", "seq", "fields"), wanted, "file_id", "inner")
    values = values.select("file_id", "entity", "seq", F.explode(F.filter("fields", lambda f: F.array_contains("wanted", f["name"]))).alias("f"))
    last = cut_lineage(values.groupBy("file_id", "entity", F.col("f.name").alias("name")).agg(F.max_by("f.text", "seq").alias("text")))
    gone = cut_lineage(both.select(F.col("prev_id").alias("file_id"), F.col("file_id").alias("step"), F.explode(_names("gone")).alias("name")))
    come = cut_lineage(both.select("file_id", F.explode(_names("come")).alias("name")))
    side = lambda names: _field_join(last, names)
    before = side(gone).select("step", "entity", F.col("name").alias("old_name"), F.col("text").alias("was"))
    after = side(come).select(F.col("file_id").alias("step"), "entity", F.col("name").alias("col_name"), F.col("text").alias("is"))
    pairs = before.join(after, ["step", "entity"]).groupBy("step", "old_name", "col_name")
    pairs = pairs.agg(F.count(F.lit(1)).alias("n"), F.sum((F.col("was") == F.col("is")).cast("long")).alias("same"))
    pairs = pairs.where(F.col("same") * RENAME_SHARE[1] >= F.col("n") * RENAME_SHARE[0])
    ranked = F.array_sort(F.collect_list(F.struct((-F.col("same") / F.col("n")).alias("share"), (-F.col("same")).alias("same"), "old_name", "col_name")))
    empty = F.expr("cast(array() as array<struct<old_name:string,col_name:string>>)")

    def settle(done: Column, p: Column) -> Column:
        """The pair, unless one of its ends has a better partner."""
        taken = F.exists(done, lambda d: (d["old_name"] == p["old_name"]) | (d["col_name"] == p["col_name"]))
        return F.when(taken, done).otherwise(F.concat(done, F.array(F.struct(p["old_name"].alias("old_name"), p["col_name"].alias("col_name")))))

    return pairs.groupBy(F.col("step").alias("file_id")).agg(ranked.alias("ranked")).select("file_id", F.aggregate("ranked", empty, settle).alias("pairs"))


def _field_join(values: DataFrame, names: DataFrame) -> DataFrame:
    key = F.struct("file_id", "name")
    extra = [x for x in names.columns if x not in ("file_id", "name")]
    return lookup_join(values.withColumn("__key", key), names.select(key.alias("__key"), *extra), "__key", "inner").drop("__key")


@dataclass(frozen=True)
class Drift:
    """What ``follow_schemas`` found: the valid lines, the schema of each file and the changes between files."""

    lines: DataFrame
    files: DataFrame
    changes: DataFrame
    drops: Drops = field(default_factory=Drops)


def follow_schemas(drops: DataFrame, c: Drops = Drops()) -> Drift:
    """Changes of each file against the file before it in its stream.

    Changes: ``file_id``, ``prev_id``, ``old_name``, ``col_name``, ``old_kind``, ``new_kind``, ``change_kind`` (renamed, removed, added, retyped).
    Files whose fingerprint is that of the file before have none and are not looked at; nor has a stream's first file. An entity with several values of a
    field in one file counts with its last line. Gone and new fields are matched one to one: the pair that
    agrees for the largest share first, then for the most entities, then by name, until no pair is left. An empty table has no changes.
    """
    lines = cut_lineage(parse_lines(drops, c)).where("fields is not null")  # written first: a filter would make the fields twice
    files = cut_lineage(schema_versions(drops, lines, c))
    moved = files.where("prev_id is not null and schema <> prev_schema")
    steps = cut_lineage(moved.select("file_id", "prev_id", "schema", "prev_schema", _lacking("prev_schema", "schema").alias("gone"), _lacking("schema", "prev_schema").alias("come")))
    steps = steps.join(_renames(lines, steps), "file_id", "left").withColumn("pairs", F.coalesce("pairs", F.expr("cast(array() as array<struct<old_name:string,col_name:string>>)")))
    was, now = F.map_from_entries("prev_schema"), F.map_from_entries("schema")

    def change(old: Column, new: Column, kind: str) -> Column:
        parts = (old.alias("old_name"), new.alias("col_name"), F.try_element_at(was, old).alias("old_kind"), F.try_element_at(now, new).alias("new_kind"))
        return F.struct(*parts, F.lit(kind).alias("change_kind")).cast(_CHANGE)

    none = F.lit(None).cast("string")
    olds, news = F.transform("pairs", lambda p: p["old_name"]), F.transform("pairs", lambda p: p["col_name"])
    renamed = F.transform("pairs", lambda p: change(p["old_name"], p["col_name"], "renamed"))
    removed = F.transform(F.filter("gone", lambda f: ~F.array_contains(olds, f["name"])), lambda f: F.struct(f["name"].alias("old_name"), f["name"].alias("col_name"), f["kind"].alias("old_kind"), none.alias("new_kind"), F.lit("removed").alias("change_kind")).cast(_CHANGE))
    added = F.transform(F.filter("come", lambda f: ~F.array_contains(news, f["name"])), lambda f: change(none, f["name"], "added"))
    kept = F.filter("schema", lambda f: F.array_contains(_names("prev_schema"), f["name"]))
    both = F.concat(F.transform("pairs", lambda p: change(p["old_name"], p["col_name"], "retyped")), F.transform(kept, lambda f: change(f["name"], f["name"], "retyped")))
    retyped = F.filter(both, lambda x: x["old_kind"] != x["new_kind"])
    changes = steps.select("file_id", "prev_id", F.explode(F.concat(renamed, removed, added, retyped)).alias("c")).select("file_id", "prev_id", "c.*")
    return Drift(lines, files, cut_lineage(changes), c)


def schema_changes(drops: DataFrame, c: Drops = Drops()) -> DataFrame:
    """The changes of ``follow_schemas``."""
    return follow_schemas(drops, c).changes


def migration_steps(drift: Drift, targets: Mapping[str, Target]) -> DataFrame:
    """The rules that each file goes through: ``file_id``, ``name``, ``kind``, ``target``, ``to_kind``, ``rule``.

    One row per field of the file: it comes to the column of its own name (``own``), of the field that it descends from through the renames of all earlier files (``earlier``),
    or of the field that it becomes (``later``), and is cast from ``kind`` to ``to_kind``; without a column it is kept as it is (``rest``). One more row, without a name, per column that
    the file lacks (``default``).
    """
    named = F.create_map(*[x for col, t in targets.items() for n in t.names for x in (F.lit(n.lower()), F.lit(col))])
    kinds = F.create_map(*[x for col, t in targets.items() for x in (F.lit(col), F.lit(t.kind))])
    fold = F.lower(F.regexp_replace("name", "[^A-Za-z0-9]", ""))
    # files of one schema in a row take the same steps: only the first of them is followed
    files = drift.files
    starts = F.col("prev_id").isNull() | (F.col("schema") != F.col("prev_schema"))
    w = Window.partitionBy("stream").orderBy("version")
    runs = cut_lineage(files.withColumn("run", F.last(F.when(starts, F.col("file_id")), ignorenulls=True).over(w)).select("file_id", "stream", "version", "run", "schema"))
    heads = runs.where("file_id = run").withColumn("prev_run", F.lag("run").over(w))
    nodes = heads.select(F.col("run").alias("file_id"), F.col("prev_run").alias("prev_id"), F.explode("schema").alias("f")).select("file_id", "prev_id", "f.name").withColumn("target", F.try_element_at(named, fold))
    routes = _route(nodes, drift.changes.where("change_kind = 'renamed'").select("file_id", "old_name", "col_name"))
    rule = F.get(F.array(F.lit("own"), F.lit("earlier"), F.lit("later")), F.col("rank"))
    fields = runs.select("file_id", "run", F.explode("schema").alias("f")).select("file_id", "run", "f.*")
    fields = fields.join(routes.withColumnRenamed("file_id", "run"), ["run", "name"], "left").select("file_id", "name", "kind", "target", F.coalesce(rule, F.lit("rest")).alias("rule"))
    held = fields.groupBy("file_id").agg(F.collect_set("target").alias("held"))
    lacking = files.select("file_id").join(held, "file_id", "left").select("file_id", F.explode(F.array_except(F.array(*map(F.lit, targets)), F.coalesce("held", F.expr("cast(array() as array<string>)")))).alias("target"))
    none = F.lit(None).cast("string")
    steps = fields.unionByName(lacking.select("file_id", none.alias("name"), none.alias("kind"), "target", F.lit("default").alias("rule")))
    return steps.select("file_id", "name", "kind", "target", F.try_element_at(kinds, F.col("target")).alias("to_kind"), "rule")


def _cast(text: Column, kind: Column, to: str) -> Column:
    """The cast rule: a text as a value of a type, or null if it is none."""
    items = F.from_json(text, "array<string>")
    if to == "array<string>":
        return F.when(kind == "array", items).otherwise(F.when(text.isNotNull(), F.array(text)))
    flat = F.when(kind == "array", F.array_join(items, "; ")).otherwise(text)
    pattern = {"bigint": r"^-?[0-9]+$", "double": r"^-?[0-9]+(\.[0-9]+)?([eE][-+]?[0-9]+)?$"}.get(to)
    return F.when(flat.rlike(pattern), flat.try_cast(to)) if pattern else flat


def consistent_table(drift: Drift, targets: Mapping[str, Target]) -> DataFrame:
    """All valid lines as one table: file, stream, seq, entity, one typed column per target and ``remainder``.

    Every line goes through the migration steps of its file, so values are renamed and cast where they lie. A null stays null; a file that lacks
    a field gives the column's default. ``remainder`` lists name and value of
    all that has no place in a column: fields without one, values that are none of its type, and, where several fields of a line lead to one column, those after the first
    (a known name before a field renamed from one, then a field renamed to one later, then by name). Lines equal in all of this come once.
    """
    steps = migration_steps(drift, targets)
    order = F.array_position(F.array(*map(F.lit, ("own", "earlier", "later"))), F.col("rule")).cast("int")
    routes = steps.where("rule not in ('rest', 'default')").groupBy("file_id").agg(F.collect_list(F.struct("name", "target", order.alias("rank"))).alias("routes"))
    lacks = steps.where("rule = 'default'").groupBy("file_id").agg(F.collect_list("target").alias("lacks"))
    plans = cut_lineage(drift.files.select("file_id").join(routes, "file_id", "left").join(lacks, "file_id", "left"))
    rows = lookup_join(drift.lines, plans, "file_id")
    by_name = F.map_from_entries(F.transform("routes", lambda r: F.struct(r["name"].alias("k"), F.struct(r["target"].alias("target"), r["rank"].alias("rank")).alias("v"))))
    rows = rows.withColumn("by_name", by_name)

    def routed(f: Column) -> Column:
        r = F.try_element_at("by_name", f["name"])
        fits = [F.when(r["target"] == t, F.isnotnull(_cast(f["text"], f["kind"], spec.kind))) for t, spec in targets.items()]
        target = F.when(F.coalesce(*fits, F.lit(False)), r["target"])
        return F.struct(F.coalesce(target, F.lit("")).alias("target"), F.coalesce(r["rank"], F.lit(9)).alias("rank"), f["name"].alias("name"), f["kind"].alias("kind"), f["text"].alias("text"))

    rows = rows.withColumn("fields", F.array_sort(F.transform("fields", routed)))
    goes_to = lambda t: lambda f: f["target"] == t
    rows = rows.withColumns({f"__{i}": F.get(F.filter("fields", goes_to(t)), F.lit(0)) for i, t in enumerate(targets)})
    out = []
    for i, (t, spec) in enumerate(targets.items()):
        f = F.col(f"__{i}")
        value = _cast(f["text"], f["kind"], spec.kind)
        if spec.default is not None:
            default = F.from_json(F.lit(spec.default), "array<string>") if spec.kind == "array<string>" else F.lit(spec.default).cast(spec.kind)
            value = F.coalesce(value, F.when(F.array_contains("lacks", t), default))
        out.append(value.alias(t))
    taken = F.array(*[F.col(f"__{i}")["name"] for i in range(len(targets))])
    left = F.filter("fields", lambda f: ~F.coalesce(F.array_contains(F.array_compact(taken), f["name"]), F.lit(False)))
    rest = F.array_sort(F.transform(left, lambda f: F.struct(f["name"].alias("name"), _cast(f["text"], f["kind"], "string").alias("value"))))
    return rows.select("file_id", "stream", "seq", "entity", *out, rest.alias("remainder")).distinct()


def _route(fields: DataFrame, steps: DataFrame) -> DataFrame:
    """Target of each field of each file that has one, and its ``rank``: 0 by its own name, 1 from the field it comes from, 2 from the
    field it becomes, through any number of files.
    """
    back = fields.select("file_id", "prev_id", "name", "target").join(steps.select("file_id", F.col("col_name").alias("name"), "old_name"), ["file_id", "name"], "left")
    nodes = cut_lineage(back.select("file_id", "name", "target", F.when(F.col("target").isNotNull(), 0).alias("rank"), "prev_id", F.coalesce("old_name", "name").alias("prev_name")))
    earlier = _follow(nodes.withColumnsRenamed({"prev_id": "to_id", "prev_name": "to_name"}), 1)
    after = nodes.where("prev_id is not null").select(F.col("prev_id").alias("file_id"), F.col("prev_name").alias("name"), F.col("file_id").alias("to_id"), F.col("name").alias("to_name"))
    later = _follow(cut_lineage(earlier.select("file_id", "name", "target", "rank").join(after, ["file_id", "name"], "left")), 2)
    return later.where("target is not null").select("file_id", "name", "target", "rank")


def _follow(nodes: DataFrame, rank: int) -> DataFrame:
    """Each node without a target takes the nearest along ``to_id``, ``to_name``: pointers double their reach each round."""
    while nodes.where("target is null and to_id is not null").limit(1).count():
        up = nodes.select(F.col("file_id").alias("to_id"), F.col("name").alias("to_name"), F.col("target").alias("t"), F.col("to_id").alias("p"), F.col("to_name").alias("n"))
        found = F.coalesce("rank", F.when(F.col("t").isNotNull(), rank)).alias("rank")
        old, nodes = nodes, cut_lineage(nodes.join(up, ["to_id", "to_name"], "left").select("file_id", "name", F.coalesce("target", "t").alias("target"), found, F.col("p").alias("to_id"), F.col("n").alias("to_name")))
        discard(old)
    return nodes
