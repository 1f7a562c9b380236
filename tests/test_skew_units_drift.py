"""Tree aggregation, units and drifting schemas on small cases."""

import datetime as dt
import json
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from axonframe.operators import units as U
from axonframe.operators.schema_drift import Target, consistent_table, follow_schemas, migration_steps, schema_changes
from axonframe.plans import tree_aggregate
from axonframe.queries import points
from axonframe.queries.drift import TARGETS
from axonframe.queries.skew import heavy_values

# ---- tree aggregation


@pytest.mark.parametrize("levels", [1, 2, 3, None])
def test_tree_equals_plain_aggregation(spark, levels):
    r = random.Random(7)
    rows = [(r.choice([1] * 50 + [None, 2, 3, *range(100)]), r.choice([None, 1, 5])) for _ in range(3000)]
    df = spark.createDataFrame(rows, "k bigint, v bigint").repartition(13).withColumn("__node", F.lit("x"))
    got = tree_aggregate(df, ["k"], {"n": (F.count(F.lit(1)), F.sum), "s": (F.sum("v"), F.sum), "m": (F.max("v"), F.max)}, fan_in=3, levels=levels)
    want = df.groupBy("k").agg(F.count(F.lit(1)).alias("n"), F.sum("v").alias("s"), F.max("v").alias("m"))
    assert Counter(map(tuple, got.collect())) == Counter(map(tuple, want.collect()))


def test_heavy_values(spark):
    rows = [(1,)] * 50 + [(0,)] * 2 + [(None,)] * 100 + [(i,) for i in range(1000, 1040)] + [(9,)]
    df = spark.createDataFrame(rows, "pre bigint")
    n = Counter(r[0] for r in rows if r[0] is not None)
    assert {r.key_id for r in heavy_values(df, "pre").collect()} == {k for k, c in n.items() if c * 100 >= len(rows)}
    assert heavy_values(df.limit(0), "pre").count() == 0


# ---- units


def test_alias_dictionary(spark):
    spelled = {"nm": "nm", "NM": "nm", " nm ": "nm", "Nanometres": "nm", "nanometer": "nm", "nanometrs": "nm", "µm": "um", "μm": "um", "UM": "um", "micron": "um", "microns": "um", "mircon": "um", "mm": "mm", "millimeters": "mm", "VOX": "voxel", "vx": "voxel", "voxels": "voxel", "voxle": "voxel"}
    not_units = ["", None, "mn", "m", "um2", "note", "number", "pixel", "section", "meter"]
    df = spark.createDataFrame([(s,) for s in [*spelled, *not_units]], "u string")
    got = {r.folded: r.unit for r in U.alias_dictionary(df, "u").collect()}
    fold = lambda s: s.strip().lower().replace("µ", "u").replace("μ", "u")
    assert got == {fold(s): u for s, u in spelled.items()}


def test_text_statements(spark):
    texts = {
        "pre site in nm": ("nm", None, None), "postsynaptic point: µm": (None, "um", None), "coords in voxels": (None, None, "voxel"), "re-export, both sites mm": (None, None, "mm"),
        "unit of pre_x, pre_y, pre_z is vox": ("voxel", None, None), "cleft ~20 nm": None, "0.4 um from branch": None, "T-bar 60 nm wide": None, "nucleus 4.5 um wide, soma point in mm": (None, None, "mm"), "see ticket": None, "": None, "(nm) legacy sheet": (None, None, "nm"),
    }
    got = {r.t: (r["__pre_unit"], r["__post_unit"], r["__any_unit"]) for r in U.text_statements(spark.createDataFrame([(t,) for t in [*texts, None]], "t string"), "t").collect()}
    assert got == {t: u for t, u in texts.items() if u}


FEEDS = [("f", 4.0, 4.0, 40.0, "nm", 40000.0, 760000.0, 30000.0, 400000.0, 4000.0, 270000.0), ("v", 16.0, 16.0, 15.0, "voxel", 40000.0, 760000.0, 30000.0, 400000.0, 4000.0, 270000.0)]
FEED_SCHEMA = "feed string, voxel_x double, voxel_y double, voxel_z double, default_unit string, " + ", ".join(f"box_{m}_{a} double" for a in "xyz" for m in ("min", "max"))


def test_units_of_synapses(spark):
    nan, none = float("nan"), (None, None, None)
    nm, um = (50000.0, 40000.0, 5000.0), (50.0, 40.0, 5.0)
    vox = (12500.0, 10000.0, 125.0)
    rows = [
        (1, nm, nm, None, None, "f"), (2, um, um, "um", None, "f"), (3, um, nm, None, None, "f"), (4, nm, vox, "nm", "post coordinates are voxel", "f"),
        (5, none, (nan, None, nan), "um", None, "f"), (6, (None, None, 5000.0), nm, None, "coords in nm", "v"), (7, nm, nm, "nanometrs", None, None), (8, (3125.0, 2500.0, 333.0), nm, None, "cleft ~20 nm", "v"), (9, nm, nm, "nm", "coords in um", "f"),
    ]
    flat = [(i, *a, *b, u, n, f, dt.datetime(2024, 1, 1)) for i, a, b, u, n, f in rows]
    df = spark.createDataFrame(flat, "id bigint, " + ", ".join(f"{s}_{a} double" for s in ("pre", "post") for a in "xyz") + ", unit string, note string, feed string, loaded_at timestamp")
    df = df.withColumn("voxel_x", F.lit(1)).withColumn("folded", F.lit("x"))
    name = lambda c: None if c is None else U.UNITS[c]
    got = {r.id: (name(r.pre_code), name(r.post_code)) for r in points.synapse_units(df, spark.createDataFrame(FEEDS, FEED_SCHEMA)).collect()}
    assert got == {1: ("nm", "nm"), 2: ("um", "um"), 3: ("um", "nm"), 4: ("nm", "voxel"), 5: (None, None), 6: ("nm", "nm"), 7: ("nm", "nm"), 8: ("voxel", "nm"), 9: ("nm", "nm")}
    assert points.synapse_units(df.limit(0), spark.createDataFrame(FEEDS, FEED_SCHEMA)).count() == 0


def test_units_of_somas(spark):
    rows = [
        (1, 50000.0, 40000.0, 5000.0, None, None, None, "f"), (2, None, None, None, None, "x=50 y=40 z=5 microns", None, "f"), (3, None, None, None, "nm", "(12500, 10000, 125) vox", None, "f"),
        (4, None, None, None, None, "n/a", None, "f"), (5, None, None, None, None, "50000 40000 5000", "coords nm, from sheet", "v"), (6, None, None, None, "mm", "[0.05; 0.04; 0.005]", "soma 6 um across", "f"),
    ]
    df = spark.createDataFrame([(*r, dt.datetime(2024, 1, 1)) for r in rows], "id bigint, soma_x double, soma_y double, soma_z double, soma_unit string, soma_text string, remark string, feed string, updated_at timestamp")
    units = points.soma_units(df, spark.createDataFrame(FEEDS, FEED_SCHEMA)).select("id", U.unit_name(F.col("soma_code")).alias("unit"), U.to_nm(F.col("soma__x"), F.col("soma_code"), "x").alias("nm"))
    out = {r.id: (r.unit, r.nm) for r in units.collect()}
    assert out == {1: ("nm", 50000.0), 2: ("um", 50000.0), 3: ("voxel", 50000.0), 4: (None, None), 5: ("nm", 50000.0), 6: ("mm", 50000.0)}


def test_long_spellings_are_judged_by_their_distance(spark):
    said = {"n a n o m e t e r s": "nm", "m-i-l-l-i-m-e-t-e-r-s": "mm", "nm": "nm", "nms": "nm", "nm.": "nm", "nanometrs": "nm", "micronz": "um", "x" * 3000: None, "nanometers of the soma": None, "": None, None: None, "." * 3000: None}
    df = spark.createDataFrame([(s,) for s in said], "u string")
    got = {r.folded: r.unit for r in U.alias_dictionary(df, "u").collect()}
    assert got == {s: u for s, u in said.items() if u}


# ---- drift

DROPS = "file_id bigint, stream string, exported_at timestamp, seq int, root_id bigint, payload string"


def files(*contents, stream="s"):
    rows = []
    for f, lines in enumerate(contents, 1):
        for q, (root, value) in enumerate(lines, 1):
            rows.append((f, stream, dt.datetime(2024, 1, f), q, root, value if isinstance(value, str) or value is None else json.dumps(value)))
    return rows


def changes(spark, rows):
    return sorted((r.file_id, r.col_name, r.change_kind) for r in schema_changes(spark.createDataFrame(rows, DROPS)).collect())


def test_changes(spark):
    one = [(i, {"type": f"T{i}", "status": "ok", "n": i, "gone": None}) for i in range(5)]
    two = [(i, {"cellType": f"T{i}" if i else "other", "status": True, "n": i + 0.5, "extra": [1]}) for i in range(5)]
    three = [(i, {"cellType": f"T{i}", "status": "ok", "n": "x" if i else 3}) for i in range(5)] + [(1, '{"status": '), (2, None), (3, ""), (4, "[1]")]
    got = changes(spark, files(one, two, three)[::-1])
    assert got == [(2, "cellType", "renamed"), (2, "extra", "added"), (2, "n", "retyped"), (2, "status", "retyped"), (3, "extra", "removed"), (3, "n", "retyped"), (3, "status", "retyped")]


def test_rename_needs_agreement_and_can_retype(spark):
    one = [(i, {"a": i, "b": f"b{i}"}) for i in range(5)]
    two = [(i, {"c": str(i), "d": f"b{i}" if i > 1 else "z"}) for i in range(5)]
    assert changes(spark, files(one, two)) == [(2, "b", "removed"), (2, "c", "renamed"), (2, "c", "retyped"), (2, "d", "added")]
    assert changes(spark, files(one)) == [] and schema_changes(spark.createDataFrame([], DROPS)).count() == 0


def test_equal_fields_are_all_renamed(spark):
    one = [(i, {f"a{k}": True for k in range(5)}) for i in range(5)]
    two = [(i, {f"b{k}": True for k in range(4)}) for i in range(5)]
    assert changes(spark, files(one, two)) == [(2, "a4", "removed")] + [(2, f"b{k}", "renamed") for k in range(4)]


def test_consistent_table(spark):
    one = [(i, {"type": f"T{i}", "status": "ok"}) for i in range(5)]
    two = [(i, {"strange": f"T{i}", "Status": "ok"}) for i in range(5)]
    three = [(i, {"odd": f"T{i}", "Status": None}) for i in range(4)] + [(4, {"odd": ["T4", "T5"]})]
    four = [(i, {"odder": f"T{i}"}) for i in range(5)] + [(9, "bad"), (None, {})]
    df = spark.createDataFrame(files(one, two, three, four), DROPS)
    rows = {(r.file_id, r.seq): r for r in consistent_table(follow_schemas(df), {k: TARGETS[k] for k in ("type", "status")}).collect()}
    assert len(rows) == 21 and (4, 6) not in rows and rows[4, 7].type is None
    assert [rows[f, 2].type for f in (1, 2, 3, 4)] == ["T1"] * 4 and rows[3, 5].type == "T4; T5"
    assert [rows[f, 1].status for f in (1, 2, 3, 4)] == ["ok", "ok", None, None]


def test_consistent_table_keeps_every_field(spark):
    one = [(i, {"early": f"T{i}", "conf": i / 8, "note": f"n{i}"}) for i in range(5)]
    two = [(i, {"earlier": f"T{i}", "conf": i / 8, "note": f"n{i}"}) for i in range(5)]
    three = [(i, {"cellType": f"T{i}", "type": f"U{i}", "conf": i / 8, "note": [f"n{i}", "x"]}) for i in range(5)]
    df = spark.createDataFrame(files(one, two, three) + [(None, "s", None, 1, 7, '{"note": "no file"}')], DROPS)
    rows = {(r.file_id, r.seq): r for r in consistent_table(follow_schemas(df), {k: TARGETS[k] for k in ("type", "confidence")}).collect()}
    rest = {at: dict(map(tuple, r.remainder)) for at, r in rows.items()}
    assert len(rows) == 16 and rest[None, 1] == {"note": "no file"}
    for i in range(5):
        assert [(rows[f, i + 1].type, rows[f, i + 1].confidence) for f in (1, 2, 3)] == [(f"T{i}", i / 8)] * 3
        assert [rest[f, i + 1] for f in (1, 2, 3)] == [{"note": f"n{i}"}] * 2 + [{"note": f"n{i}; x", "type": f"U{i}"}]


def test_casts_defaults_and_schema_numbers(spark):
    one = [(1, {"n_syn": "12", "tags": ["a", "b"]}), (2, {"n_syn": 7, "tags": "c"}), (3, {"n_syn": "many", "tags": None})]
    two = [(1, {"n_syn": 5}), (2, "[1, 2]"), (3, "7")]
    df = spark.createDataFrame(files(one, two, one, two), DROPS).withColumn("kind", F.lit("x")).withColumn("fields", F.lit(1))
    drift = follow_schemas(df)
    targets = {"n": Target(("nsyn",), "bigint"), "tags": Target(("tags",), "array<string>", default="[]")}
    rows = {(r.file_id, r.seq): (r.n, r.tags, [tuple(x) for x in r.remainder]) for r in consistent_table(drift, targets).collect()}
    first = {1: (12, ["a", "b"], []), 2: (7, ["c"], []), 3: (None, None, [("n_syn", "many")])}
    assert rows == {(f, q): v for f in (1, 3) for q, v in first.items()} | {(2, 1): (5, [], []), (4, 1): (5, [], [])}
    assert sorted((r.file_id, r.version, r.schema_no) for r in drift.files.collect()) == [(1, 1, 1), (2, 2, 2), (3, 3, 1), (4, 4, 2)]
    steps = {(r.file_id, r.name, r.target, r.to_kind, r.rule) for r in migration_steps(drift, targets).collect()}
    assert {(2, "n_syn", "n", "bigint", "own"), (2, None, "tags", "array<string>", "default"), (1, "tags", "tags", "array<string>", "own")} <= steps and len(steps) == 8
    empty = follow_schemas(df.limit(0))
    assert consistent_table(empty, targets).count() == 0 and migration_steps(empty, targets).count() == 0
