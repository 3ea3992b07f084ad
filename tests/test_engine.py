"""The measurement engine: golden values of small fixtures, identities, and all registered queries."""

import json
import math
import random
import struct
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from rasterloom import model
from rasterloom.functions import geometry, pixel, scalar
from rasterloom.operators import batch, marker, masks, objects, quality, raster, review, runs, segment, spatial
from rasterloom.sources import ini, slide_index, tables
from rasterloom.streaming import telemetry

NAMES = ["A", "B", "C"]


def grid(spark, width=32, height=8):
    """Stripes of four pixels: channel c is 200 where bit c of the stripe's number is set, else 20."""
    rows = [(x, y, *[200 if (x // 4) >> c & 1 else 20 for c in range(3)]) for x in range(width) for y in range(height)]
    return spark.createDataFrame(rows, "px int, py int, A int, B int, C int")


def masked(df):
    return pixel.bitmask([F.col(n) for n in NAMES], [100, 100, 100])


def test_hole_region_and_area(spark):
    region = model.Region(((2.5, 0.5, 30.5, 7.5),), ((9.5, 1.5, 16.5, 8.5),))
    px = grid(spark).where(pixel.inside(F.col("px") + 0.5, F.col("py") + 0.5, region))
    want = sum(2.5 <= x + 0.5 < 30.5 and 0.5 <= y + 0.5 < 7.5 and not (9.5 <= x + 0.5 < 16.5 and 1.5 <= y + 0.5 < 8.5) for x in range(32) for y in range(8))
    hist = marker.histogram(px, masked(px))
    assert hist.agg(F.sum("n")).first()[0] == want
    assert marker.sampled_area_mm2(147, 1, 0.5, 0.75) == 147 * 0.5 * 0.75 / 1e6


def test_whole_grid_combinations(spark):
    hist = marker.histogram(grid(spark), masked(None))
    rows = {r["mask"]: r for r in marker.combinations(hist, 3).collect()}
    assert {m: (rows[m].inclusive, rows[m].exact) for m in (1, 3, 7)} == {1: (128, 32), 3: (64, 32), 7: (32, 32)} and rows[1].total == 256
    order = [r["mask"] for r in marker.enumeration_order(marker.combinations(hist, 3)).collect()]
    assert order == [7, 3, 5, 6, 1, 2, 4]
    long = marker.long_table(marker.combinations(hist, 3), NAMES, "PA", "all_sampled_roi_pixels", 2.0)
    assert long.count() == marker.expected_rows(3, 1) and marker.expected_rows(3, 4) == 152
    assert runs.violations(long, F.col("mask"), runs.combination_rules(NAMES)).count() == 0
    row = long.where("mask = 3 AND mode = 'exact' AND denominator_type = 'positive:A'").first()
    assert (row.numerator, row.denominator, row.ratio, row.positive_area_mm2) == (32, 128, 0.25, 0.25)


@settings(max_examples=8, deadline=None)
@given(st.dictionaries(st.integers(0, 15), st.integers(1, 50), max_size=16))
def test_lattice_equals_cube_and_brute_force(spark, counts):
    hist = spark.createDataFrame(list(counts.items()), "mask int, n long")
    lattice = {r["mask"]: r.inclusive for r in marker.combinations(hist, 4).collect()}
    brute = {m: sum(n for s, n in counts.items() if s & m == m) for m in range(1, 16)} if counts else {}
    assert lattice == brute
    assert {r["mask"]: r.inclusive for r in marker.inclusive_by_cube(hist, 4).collect()} == {m: n for m, n in brute.items() if n}


def test_partition_additivity(spark):
    px = grid(spark)
    whole = {r["mask"]: r.n for r in marker.histogram(px, masked(px)).collect()}
    halves = [{r["mask"]: r.n for r in marker.histogram(px.where(c), masked(px)).collect()} for c in ("px < 13", "px >= 13")]
    assert whole == {m: sum(h.get(m, 0) for h in halves) for m in whole}


def test_labels_and_filters(spark):
    assert pixel.zero_mask([0, -1, 1]) == 3
    row = spark.range(1).select(
        pixel.label_text(F.lit(5), NAMES), pixel.label_matches(F.lit(0), 0), pixel.label_matches(F.lit(1), 0), pixel.label_matches(F.lit(6), 4), pixel.label_matches(F.lit(6), 4, True),
        pixel.outline_matches(F.lit(0), 0), pixel.stored_band(F.lit(0), F.lit(3)), pixel.stored_band(F.lit(2), F.lit(1)), pixel.mask_hue(F.lit(0))).first()
    assert tuple(row) == ("A+C", False, False, True, False, True, 2, 0, None)
    with pytest.raises(Exception, match="not finite"):
        spark.range(1).select(pixel.bitmask([F.lit(float("nan"))], [1.0])).collect()


def test_objects(spark):
    px = [(x, y, "split", "n" if x < 8 else "c") for x in range(4, 12) for y in range(4)] + [(0, 0, "no-cytoplasm", "n")]
    cells = grid(spark).join(spark.createDataFrame(px, "px int, py int, id string, part string"), ["px", "py"])
    means = objects.compartment_means(cells, "id", F.col("part") == "n", F.col("part") == "c", NAMES)
    got = {r.id: r for r in objects.phenotype_masks(means, NAMES, [100] * 3, [100] * 3).collect()}
    s = got["split"]
    assert (s.npn, s.cpn, s.pn, s.A_nucleus, s.B_nucleus, s.A_cytoplasm, s.B_cytoplasm) == (1, 2, 3, 200.0, 20.0, 20.0, 200.0)
    why = means.select("id", objects.measurement_failure(F.col("nucleus_pixels"), F.col("cytoplasm_pixels")).alias("w"))
    assert {r.id: r.w for r in why.collect()} == {"split": None, "no-cytoplasm": "no_valid_cytoplasm_pixels"}
    order = objects.first_failure(objects.ELIGIBILITY, {"nucleus_not_inside_cell": F.lit(True), "missing_nucleus_roi": F.col("id") == 1})
    assert [r.w for r in spark.range(2).select(order.alias("w")).collect()] == ["nucleus_not_inside_cell", "missing_nucleus_roi"]
    cover = lambda p, m, r: spark.range(1).select(objects.coverage(F.lit(p), F.lit(m), F.lit(r)).alias("c")).first().c
    assert cover(0, 0, 0).status == "no_cell_candidates" and cover(0, 0, 0).fraction is None
    assert round(cover(4250, 2582, 1668).fraction, 3) == 0.608 and cover(3, 3, 0).status == "all_candidates_measurable"
    with pytest.raises(Exception, match="add up"):
        cover(3, 1, 1)


def cells_in_files(path, files=6, orders=3000):
    """orders and lineitem whose means often lie at a threshold, with the lines of an order scattered over files; the lines as stored."""
    pa, pq = pytest.importorskip("pyarrow"), pytest.importorskip("pyarrow.parquet")
    rng = random.Random(11)
    lines = [(rng.randrange(orders), rng.randrange(20, 900), rng.randrange(1, 7), rng.choice([25.0, 26.0, 27.0]), rng.choice([47_999.9, 48_000.1, 50_000.3, 49_999.7]),
              rng.randrange(3, 8) / 100, rng.randrange(2, 7) / 100, rng.choice("FO")) for _ in range(orders * 6)]
    names = ["l_orderkey", "l_partkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_linestatus"]
    (path / "lineitem.parquet").mkdir()
    for i in range(files):
        part = lines[i * len(lines) // files:(i + 1) * len(lines) // files]
        pq.write_table(pa.table(dict(zip(names, map(list, zip(*part)), strict=True))), path / "lineitem.parquet" / f"part-{i}.parquet", row_group_size=500)
    pq.write_table(pa.table({"o_orderkey": list(range(orders)), "o_custkey": [k % 99 for k in range(orders)], "o_orderstatus": ["P" if k % 9 == 0 else "F" for k in range(orders)],
                             "o_orderpriority": ["1"] * orders, "o_totalprice": [float(k) for k in range(orders)]}), path / "orders.parquet")
    return lines


def same_as_sql_in_one_thread(spark, path, name):
    """The SQL's own sums of doubles follow the stored order only in one thread."""
    import __spark_entry__ as entry

    con = pytest.importorskip("duckdb").connect()
    con.execute("SET threads = 1")
    con.sql(f"CREATE VIEW orders AS SELECT * FROM '{path}/orders.parquet'")
    con.sql(f"CREATE VIEW lineitem AS SELECT * FROM '{path}/lineitem.parquet/*.parquet'")
    want = con.sql(entry.oracle_sql()[name])
    got = entry.queries()[name](spark, str(path))
    columns = list(want.columns)
    assert sorted(map(str, (tuple(r[c] for c in columns) for r in got.collect()))) == sorted(map(str, want.fetchall()))


def test_cell_combinations_sum_in_stored_order(spark, tmp_path):
    cells_in_files(tmp_path)
    same_as_sql_in_one_thread(spark, tmp_path, "cell_combinations_long")


def test_cell_histograms_sum_in_stored_order(spark, tmp_path):
    """Against a plain sum of each order's lines, at two splits of the files."""
    from rasterloom.plans import object_queries as own

    lines = cells_in_files(tmp_path)
    by = {}
    for line in lines:
        by.setdefault(line[0], []).append(line)
    def mask(rows, thresholds):
        means = [0.0] * 4
        for r in rows:
            means = [m + v for m, v in zip(means, r[3:7], strict=True)]
        return sum((m / len(rows) >= t) << j for j, (m, t) in enumerate(zip(means, thresholds, strict=True)))
    want = {}
    for key, rows in by.items():
        nucleus, cytoplasm = ([r for r in rows if r[7] == s] for s in "FO")
        if key % 9 and nucleus and cytoplasm:
            n, c = mask(nucleus, own.NUCLEUS), mask(cytoplasm, own.CYTOPLASM)
            for k in (("NPN", n), ("CPN", c), ("PN", n | c)):
                want[k] = want.get(k, 0) + 1
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        for size in (before, "20k"):
            spark.conf.set("spark.sql.files.maxPartitionBytes", size)
            assert {(r.metric, r["mask"]): r.n for r in own.cell_npn_cpn_pn(spark, str(tmp_path)).collect()} == want
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_cell_histograms_take_files_by_name(spark, tmp_path):
    """Spark gives the paths as URLs, where a space, # and % are escaped and sort otherwise."""
    cells_in_files(tmp_path)
    for i, name in enumerate(("a!b", "a b", "a$b", "a#b", "a+b %", "a%2Bb")):
        (tmp_path / "lineitem.parquet" / f"part-{i}.parquet").rename(tmp_path / "lineitem.parquet" / f"{name}.parquet")
    same_as_sql_in_one_thread(spark, tmp_path, "cell_npn_cpn_pn")


def test_nuclei_sum_in_stored_order(spark, tmp_path):
    cells_in_files(tmp_path)
    same_as_sql_in_one_thread(spark, tmp_path, "nuclear_population")


def test_display_audit(spark):
    df = spark.createDataFrame([(0.0,), (10.0,), (15.0,), (20.0,), (21.0,), (float("nan"),), (float("inf"),)], "v double")
    r = quality.display_audit(df, F.col("v"), 10, 20).first()
    assert (r.finite, r.nonfinite, r.below, r.at_min, r.above, r.at_max, r.below_fraction, r.above_fraction) == (5, 2, 1, 1, 1, 1, 0.2, 0.2)
    r = quality.display_audit(df.where("v > 100 AND NOT isnan(v)"), F.col("v"), 10, 20).first()
    assert r.finite == 0 and r.below_fraction is None


def test_levels(spark):
    ds = [1.0, 2.0, 4.0, 8.0, 16.0]
    row = spark.range(1).select(raster.backward_level(F.lit(3.0), ds), raster.backward_level(F.lit(0.5), ds), raster.nearest_level(F.lit(3.0), ds), raster.nearest_level(F.lit(2.0 * math.sqrt(2)), ds), raster.nearest_level(F.lit(99.0), ds)).first()
    assert tuple(row)[:2] == (1, 0) and tuple(row)[2:] in ((2, 1, 4), (2, 2, 4))
    assert raster.tile_grid(10, 7, 4, spark.range(1)).agg(F.sum(F.col("w") * F.col("h"))).first()[0] == 70


def test_subtiles_of_images_beyond_one_grid(spark, tmp_path):
    from rasterloom.plans import raster_queries

    numbers = [0, 62, 63, 64, 4031, 4032, 4095, 4096, 4097, 4160, 8191, 8192, 19_999, 4096 * 300 + 5]
    spark.createDataFrame([(k,) for k in numbers], "p_partkey long").write.parquet(f"{tmp_path}/part.parquet")
    cameras = [(k, k % 7) for k in range(0, 1024)]
    spark.createDataFrame(cameras, "s_suppkey long, s_nationkey int").write.parquet(f"{tmp_path}/supplier.parquet")
    active = {k for k, n in cameras if k == 0 or n % 2}
    placed = [(k, a, b, k % 64 + 2 * a, k // 64 % 64 + 2 * b) for k in numbers for a in (0, 1) for b in (0, 1)]
    want = [r for r in placed if r[3] < 64 and r[4] < 64 and r[4] // 2 * 32 + r[3] // 2 in active]
    got = raster_queries.subtile_explode_active(spark, str(tmp_path)).select("image", "part_x", "part_y", "gx", "gy").collect()
    assert sorted(tuple(r) for r in got) == sorted(want) and max(want)[0] == numbers[-1]


def test_last_writer_wins_even_with_zero(spark):
    df = spark.createDataFrame([(1, 1, 0, 9), (1, 1, 2, 0), (1, 2, 1, 5)], "x int, y int, ord int, v int")
    assert {(r.x, r.y): r.v for r in raster.last_writer(df, F.col("ord"), ["v"], "x", "y").collect()} == {(1, 1): 0, (1, 2): 5}


@settings(max_examples=8, deadline=None)
@given(st.integers(0, 10_000))
def test_overlap_join_is_brute_force(spark, seed):
    rng = random.Random(seed)
    rects = lambda n: [(i, rng.randrange(-300, 300), rng.randrange(-300, 300), rng.randrange(1, 120), rng.randrange(1, 120)) for i in range(n)]
    a, b = rects(25), rects(25)
    got = spatial.overlap_join(spark.createDataFrame(a, "l_id int, lx int, ly int, lw int, lh int"), spark.createDataFrame(b, "r_id int, rx int, ry int, rw int, rh int"), 64).collect()
    want = {(p[0], q[0]) for p in a for q in b if p[1] < q[1] + q[3] and q[1] < p[1] + p[3] and p[2] < q[2] + q[4] and q[2] < p[2] + p[4]}
    assert len(got) == len(want) and {(r.l_id, r.r_id) for r in got} == want


def test_containment_pairs_of_odd_sizes_and_copies(spark, tmp_path):
    """Sides of 0 and below, over the whole plane, absent ones, ids below 0, more than once and of one place."""
    from rasterloom.plans import export_queries

    rng = random.Random(5)
    rows = [(rng.randrange(-3000, 3000), rng.choice([-40, -3, 0, 0, 1, 5, 20, 50, 600, 3000, None])) for _ in range(600)]
    rows += [(1024 * i + 7, 10 + i % 3) for i in range(-30, 30)] + [((1 << 20) * i + 7, 4) for i in range(9)] + rows[:9] + [(None, 5)]
    spark.createDataFrame(rows, "p_partkey long, p_size int").write.parquet(f"{tmp_path}/part.parquet")
    place = [(k, int(math.fmod(k * 37, 1024)), int(math.fmod(k * 91, 1024)), s) for k, s in rows if k is not None and s is not None]
    want = sorted((a, b) for a, ax, ay, s in place for b, bx, by, t in place
                  if bx >= ax and by >= ay and bx + t <= ax + 2 * s and by + t <= ay + 2 * s and 4 * s * s > t * t)
    got = sorted(tuple(r) for r in export_queries.containment_pairs(spark, str(tmp_path)).select("cell", "nucleus").collect())
    assert got == want and any(s == 0 for _, _, _, s in place)


def test_containment_pairs_joins_sets_of_copies(spark, tmp_path):
    """Ids of one place and size are joined as one row, whatever their number."""
    from rasterloom.plans import export_queries

    spark.range(2000).selectExpr("id * 1024 AS p_partkey", "CAST(10 + id % 2 AS INT) AS p_size").write.parquet(f"{tmp_path}/part.parquet")
    df = export_queries.containment_pairs(spark, str(tmp_path))
    assert df.groupBy().count().first()[0] == 2000 * 2000
    generated = df._jdf.queryExecution().optimizedPlan().toString()
    assert generated.index("explode(l_ids") < generated.index("Join ")


def test_rings(spark):
    assert geometry.simple_ring(np.array([(0, 0), (4, 0), (4, 4), (0, 4)], float)) and not geometry.simple_ring(np.array([(0, 0), (4, 4), (4, 0), (0, 4)], float))
    df = spark.createDataFrame([([(0.0, 0.0), (4.0, 0.0), (4.0, 2.0), (0.0, 2.0)],)], f"r {geometry.RING}")
    row = df.select(geometry.signed_area(F.col("r")).alias("a"), geometry.centroid(F.col("r")).alias("c"), geometry.envelope(F.col("r")).alias("e"), geometry.contains(F.col("r"), F.lit(5.0), F.lit(1.0)).alias("i")).first()
    assert (row.a, tuple(row.c), tuple(row.e), row.i) == (8.0, (2.0, 1.0), (0.0, 0.0, 4.0, 2.0), False)


def test_scalars(spark):
    row = spark.range(1).select(
        scalar.csv_cell(F.lit('=A"')), scalar.twelve_digits(F.lit(0.5)), scalar.twelve_digits(F.lit(float("nan"))), scalar.significant(F.lit(123456.0)), scalar.nice_length(F.lit(73.0)),
        scalar.escape_cell_codes(F.lit("_x0041_ _x_")), scalar.wrapped(F.lit("a" * 130)), scalar.fits_fifteen_digits(F.lit("1234567890123456")), scalar.index_ignoring_case(F.array(F.lit("Ab"), F.lit("c")), F.lit("C")),
        scalar.relative_difference(F.lit(0.0), F.lit(1.0)), scalar.safe_file_name(F.lit("a/b c"))).first()
    assert tuple(row) == ('"\'=A"""', "0.500000000000", "", 123500.0, 50.0, "_x005F_x0041_ _x_", "a" * 60 + "\n" + "a" * 60 + "\n" + "a" * 10, False, 1, float("inf"), "a-b-c")


def test_batch_states(spark):
    attempts = spark.createDataFrame([("roi0", 0, "cancelled"), ("roi0", 1, "complete"), ("roi1", 2, "failed"), ("roi3", 3, "running")], "task string, seq int, status string")
    plan = spark.createDataFrame([("roi0",), ("roi1",), ("roi2",), ("roi3",)], "task string")
    got = {r.task: r.status for r in batch.planned_status(plan, attempts, "task", F.col("seq"), "status").collect()}
    assert got == {"roi0": "complete", "roi1": "failed", "roi2": "pending", "roi3": "interrupted"}
    bad = {r.task: r.status for r in batch.planned_status(plan, attempts, "task", F.col("seq"), "status", F.lit(False)).collect()}
    assert bad["roi0"] == "invalid"


def test_validation():
    m = model.Marker(0, "A", 1, 1, 1)
    for bad in (lambda: model.Profile(0, ()), lambda: model.Profile(0, (m, m)), lambda: model.Profile(0, (m,), 2), lambda: model.Marker and model.Profile(0, tuple(model.Marker(i, str(i), 1, 1, 1) for i in range(9))),
                lambda: model.DisplayProfile(0.001, (model.DisplayChannel("a", 0, 1, 0),)), lambda: model.DisplayChannel("a", 1, 1, 0), lambda: model.TiledInference(padding=8), lambda: model.Watershed(-1), lambda: model.Region(())):
        with pytest.raises(ValueError):
            bad()


def test_slide_index(spark, tmp_path):
    from rasterloom.plans.source_queries import index_bytes

    data = index_bytes()
    path = tmp_path / "Index.dat"
    path.write_bytes(data)
    spark.dataSource.register(slide_index.SlideIndexSource)
    rows = spark.read.format("slide_index").options(path=str(path), slideId="s" * 32, counts="[2,3]", defaults="[0,0]", zoomDimension="0", filterDimension="1").load()
    want = {(0, 0, 4, 100, 10, 0), (0, 0, 5, 200, 20, 0), (0, 0, 9, 300, 30, 1), (1, 2, 7, 4_000_000_000, 40, 2)}
    assert {tuple(r) for r in rows.collect()} == want == {tuple(r) for r in slide_index.read_index(spark, f"file://{path}", "s" * 32, [2, 3], [0, 0], 0, 1).collect()}
    for bad in (b"99.99" + data[5:], data[:60]):
        with pytest.raises(ValueError):
            list(slide_index.index_rows(bad, "s" * 32, [2, 3], [0, 0], 0, 1))
    with pytest.raises(ValueError):
        slide_index.check_header(data, "t" * 32)
    loop = bytearray(data)
    head = struct.unpack_from("<I", loop, 45)[0]
    page = struct.unpack_from("<I", loop, head + 4)[0]
    struct.pack_into("<I", loop, page + 4, page)
    with pytest.raises(ValueError, match="comes back"):
        list(slide_index.entries(bytes(loop), 45, 0))
    (tmp_path / "Data0000.dat").write_bytes(bytes(range(250)))
    files = spark.createDataFrame([(0, f"file://{tmp_path}/Data0000.dat")], "file_number long, uri string")
    cut = slide_index.payloads(rows.where("file_number = 0 AND offset = 100"), files).first()
    assert bytes(cut.payload) == bytes(range(100, 110))
    packed = zlib.compress(struct.pack("<Bii", 1, 5, -7) + struct.pack("<Bii", 0, 2, 3))
    assert slide_index.stitch_positions(packed, True, 2) == [(0, 20, -28), (1, 8, 12)]
    with pytest.raises(ValueError):
        slide_index.stitch_positions(struct.pack("<Bii", 2, 0, 0), False, 0)
    flat = spark.range(1).select(slide_index.flat_index_column(F.array(F.lit(1), F.lit(2)), F.array(F.lit(2), F.lit(3)))).first()[0]
    assert flat == slide_index.flat_index([1, 2], [2, 3]) == 5


def test_ini_lookup(spark):
    rows = ini.parse_ini(spark.createDataFrame([("f", "[A]\nn=3\nbad=x\n")], "file string, text string"))
    assert ini.lookup(rows, "A", "n", "int").first().value == 3 and ini.lookup(rows, "A", "none", "int", 7).first().value == 7
    for key in ("none", "bad"):
        with pytest.raises(Exception, match="missing or malformed"):
            ini.lookup(rows, "A", key, "int").collect()


def test_tables(spark, tmp_path):
    csv = tmp_path / "t.csv"
    csv.write_text('a,b\n"x ""q""\ny",1\n')
    assert tuple(tables.read_strict_csv(spark, str(csv), "a string, b int").first()) == ('x "q"\ny', 1)
    csv.write_text("a,b\nx,notanumber\n")
    with pytest.raises(Exception):  # noqa: B017
        tables.read_strict_csv(spark, str(csv), "a string, b int").collect()
    good = {"file": "f", "levelX": 0, "levelY": 0, "width": 4, "height": 4, "roiPixels": 16, "sha256": "0" * 64}
    bad = [good | {"roiPixels": 17, "levelX": 9}, good | {"sha256": "z", "levelX": 8}, good | {"width": 0}, {"file": "x"}]
    twice = [good | {"levelX": 5}] * 2
    ok, no = tables.tile_index(spark.createDataFrame([(json.dumps(x),) for x in [good, *bad, *twice]], "value string"))
    assert ok.count() == 1 and sorted(r.reason for r in no.collect()) == ["bounds", "duplicate", "duplicate", "incomplete", "pixels", "sha256"]
    big = tmp_path / "big.bin"
    big.write_bytes(bytes(300_000))
    small = tmp_path / "small.bin"
    small.write_bytes(b"abc")
    prints = {r.size: r.sha256 for r in tables.read_fingerprints(spark, str(tmp_path / "*.bin")).collect()}
    assert len(prints) == 2 and all(len(v) == 64 for v in prints.values())


def test_publish(spark, tmp_path):
    df, path = spark.createDataFrame([(1,)], "a int"), f"file://{tmp_path}/run"
    assert not runs.is_published(spark, path)
    runs.publish(spark, path, {"t": df}, df)
    assert runs.is_published(spark, path) and spark.read.parquet(f"{path}/t").count() == 1
    with pytest.raises(FileExistsError):
        runs.publish(spark, path, {"t": df}, df)


def test_segmentation_against_one_image(spark):
    rng = np.random.default_rng(3)
    image = rng.random((60, 60)) < 0.35
    df = spark.createDataFrame([(int(x), int(y)) for y, x in zip(*np.nonzero(image), strict=True)], "x int, y int")
    got = sorted((r.object_x, r.object_y, r.pixels) for r in segment.segment_tiles(df, 20, 30).collect())
    labels = segment.connected(image)
    found, first, count = np.unique(labels, return_index=True, return_counts=True)
    assert got == sorted((int(f % 60), int(f // 60), int(c)) for k, f, c in zip(found, first, count, strict=True) if k)
    with pytest.raises(ValueError):
        segment.reconcile_tiles(3, 2, 0)


def test_masks(spark):
    px = grid(spark).select("px", "py", pixel.label_code(masked(None), F.col("px") < 30).alias("code"))
    tiles = masks.mask_tiles(px, 4)
    assert tiles.count() == 16 and tiles.where("constant IS NOT NULL").count() == 14 and masks.stored_contents(tiles).count() == 8
    stats = marker.histogram(grid(spark).where("px < 30"), masked(None))
    assert masks.finish_differences(px, stats).count() == 0
    assert masks.finish_differences(px, stats.where("mask <> 2")).count() == 1


def test_streams_equal_batches(spark, tmp_path):
    rows = [(1, f"2024-01-01T{h:02d}:{m:02d}:00Z", "scan" if m % 2 else "read", "t", "complete", 1.5, {"k": "v"}) for h in range(5) for m in (1, 20, 59)]
    df = spark.createDataFrame(rows, "schema int, time string, phase string, task string, status string, seconds double, extra map<string,string>")
    folder = str(tmp_path / "in")
    telemetry.append(df.limit(7), folder)
    telemetry.append(df.where("time >= '2024-01-01T02:20:00Z'"), folder)
    now = telemetry.tumbling(telemetry.read_batch(spark, folder), "1 hour")
    telemetry.run_once(telemetry.tumbling(telemetry.read_stream(spark, folder, "0 seconds"), "1 hour"), str(tmp_path / "out"), str(tmp_path / "ck"))
    closed = {tuple(r) for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    assert closed and closed <= {tuple(r) for r in now.collect()}
    frames = spark.createDataFrame([("a", 1, "old"), ("a", 2, "new")], "k string, g int, v string")
    assert telemetry.latest_frames(frames, "k", "g", "v").first().v == "new"


def test_review(spark):
    edges = spark.createDataFrame([("a", None), ("b", "a"), ("c", "b"), ("z", None)], "node string, parent string")
    assert {r.node: (r.root, r.depth) for r in review.owners(edges).collect()} == {"a": ("a", 0), "b": ("a", 1), "c": ("a", 2), "z": ("z", 0)}
    ring = review.circular_neighbours(spark.createDataFrame([("r", 1), ("r", 2), ("s", 5)], "g string, o int"), "g", "o")
    assert {r.o: (r.previous, r.next) for r in ring.collect()} == {1: (2, 2), 2: (1, 1), 5: (5, 5)}


def test_registered_queries_run(spark, sf):
    duckdb = pytest.importorskip("duckdb")
    import __spark_entry__ as entry
    from rasterloom.plans import registry

    assert entry.entry(spark).columns == ["combination", "mask", "inclusive", "exact", "total"]
    con = duckdb.connect()
    for t in ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    def text(v):
        return f"{v:.9g}" if isinstance(v, float) else str(v)
    for name, query in registry.QUERIES.items():
        df = query(spark, sf)
        rows = df.collect()
        if name in registry.ORACLES:
            want = con.sql(registry.ORACLES[name])
            columns = sorted(df.columns)
            assert columns == sorted(want.columns), name
            at = [want.columns.index(c) for c in columns]
            assert sorted([text(r[c]) for c in columns] for r in rows) == sorted([text(r[i]) for i in at] for r in want.fetchall()), name
