"""One analysis end to end, number texts, rings, the queue, catalogues and checks."""

import decimal
import json
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from rasterloom.functions import geometry, scalar
from rasterloom.model import Marker, Profile, Region
from rasterloom.operators import batch, export, masks, results, runs, validate
from rasterloom.sources import tables


def four_digits(text):
    try:
        v = decimal.Decimal(text)
    except decimal.InvalidOperation:
        return text
    if v == 0:
        return "0"
    v = v.normalize(decimal.Context(prec=4, rounding=decimal.ROUND_HALF_UP)).normalize()
    e = v.adjusted()
    if e < -3 or e >= 5:
        m = format(v.scaleb(-e), "f")
        return f"{m.rstrip('0').rstrip('.') if '.' in m else m}e{e}"
    return format(v, "f")


def safe(text):
    v = decimal.Context(prec=99).create_decimal(text).normalize(decimal.Context(prec=99))
    if len(v.as_tuple().digits) > 15:
        return False
    if v == 0:
        return True
    a = abs(v)
    return decimal.Decimal("1E-307") <= a <= decimal.Decimal("9.99999999999999E307") and (v.as_tuple().exponent < 0 or a < decimal.Decimal("1E15"))


def test_number_texts(spark):
    rng = random.Random(3)
    texts = ["0", "-0.000", ".5", "5.", "1e5", "99995", "99994.9", "0.00099995", "0.001", "1E400", "1000000000000000000", "1E15", "1E14", "123456789012345", "1234567890123456", "-12.345", "+7", "0.99995", "1e-308", "9.99999999999999e307"]
    texts += [f"{rng.choice(['', '-'])}{rng.randrange(10**rng.randrange(1, 9))}.{rng.randrange(10**6):06d}e{rng.randrange(-9, 9)}" for _ in range(200)]
    rows = spark.createDataFrame([(t,) for t in texts], "t string").select("t", scalar.four_digit_text(F.col("t")), scalar.fits_fifteen_digits(F.col("t"))).collect()
    assert [(r[0], r[1], r[2]) for r in rows] == [(t, four_digits(t), safe(t)) for t in texts]
    other = spark.createDataFrame([("a_X0041_x0042_",)], "t string").select(
        scalar.escape_cell_codes(F.col("t")), scalar.four_digit_text(F.lit("n/a")), scalar.fits_fifteen_digits(F.lit("1,5")), scalar.json_escape(F.lit('a"b\\\n')), scalar.safe_file_name(F.lit("//"))).first()
    assert tuple(other) == ("a_x005F_X0041_x0042_", "n/a", False, 'a\\"b\\\\\\n', "channel")


def test_rings_cover():
    square = np.array([(0, 0), (10, 0), (10, 10), (0, 10)], float)
    notched = np.array([(0, 0), (10, 0), (10, 10), (6, 10), (6, 4), (4, 4), (4, 10), (0, 10)], float)
    small = np.array([(1, 1), (9, 1), (9, 9), (1, 9)], float)
    assert geometry.covers_ring(square, small) and geometry.covers_ring(square, square) and geometry.covers_ring(square, np.roll(square[::-1], 1, axis=0))
    assert not geometry.covers_ring(small, square) and not geometry.covers_ring(notched, small) and geometry.covers_ring(notched, small[[0, 1]].repeat(1, axis=0).tolist() and np.array([(1, 1), (9, 1), (9, 3), (1, 3)], float))
    assert geometry.covers_ring(square, notched) and not geometry.covers_ring(notched, square)


def ring(x, y, w, h):
    return [{"x": float(a), "y": float(b)} for a, b in ((x, y), (x + w, y), (x + w, y + h), (x, y + h))]


def fixture(spark):
    """Stripes as in the golden grid: marker c is 200 where bit c of the stripe's number is set, else 20."""
    pixels = [(x + 0.5, y + 0.5, *[200 if (x // 4) >> c & 1 else 20 for c in range(3)]) for x in range(32) for y in range(8)]
    df = spark.createDataFrame(pixels, "x double, y double, A int, B int, C int")
    profile = Profile(0, tuple(Marker(c, n, 100, 100, 100) for c, n in enumerate("ABC")))
    cells = [("split", 0, ring(4, 0, 8, 4), ring(4, 0, 4, 4)), ("no nucleus", 1, ring(0, 0, 4, 4), None), ("outside", 2, ring(30, 0, 4, 4), ring(30, 0, 1, 1)), ("hole", 3, ring(12, 1, 6, 4), ring(16, 5, 1, 1)),
             ("sticks out", 4, ring(20, 0, 4, 4), ring(22, 0, 6, 4)), ("bow", 5, [{"x": float(a), "y": float(b)} for a, b in ((24, 0), (28, 4), (28, 0), (24, 4))], ring(24, 0, 1, 1)), ("thin", 6, ring(28.6, 0.6, 0.2, 0.2), ring(28.6, 0.6, 0.1, 0.1))]
    return df, profile, spark.createDataFrame(cells, f"cell_id string, ord int, cell {geometry.RING}, nucleus {geometry.RING}")


def test_analysis(spark, tmp_path):
    pixels, profile, cells = fixture(spark)
    a = results.analyze(pixels, Region(((0, 0, 32, 8),), ((14, 1, 18, 3),)), profile, cells, results.Image(32, 8, (0.5, 0.75)))
    assert a.roi_pixels == 256 - 8
    row = a.cells.collect()
    assert [(r.cell_id, r.x, r.y, r.nucleus_pixels, r.cytoplasm_pixels, r.npn, r.cpn, r.pn, r.A_nucleus, r.B_cytoplasm) for r in row] == [("split", 8.0, 2.0, 16, 16, 1, 2, 3, 200.0, 200.0)]
    assert {(r.cell_id, r.stage, r.reason) for r in a.excluded_cells.collect()} == {
        ("no nucleus", "eligibility", "missing_nucleus_roi"), ("outside", "eligibility", "cell_outside_image"), ("hole", "eligibility", "cell_not_fully_inside_roi"),
        ("sticks out", "eligibility", "nucleus_not_inside_cell"), ("bow", "eligibility", "invalid_cell_geometry"), ("thin", "measurement", "no_valid_compartment_pixels")}
    assert {(r.cell_id, r.pixels, r["mask"]) for r in a.nuclei.collect()} == {("split", 16, 1), ("outside", 1, 7), ("hole", 1, 4), ("sticks out", 24, 6), ("bow", 1, 6)}
    assert {(r.cell_id, r.reason) for r in a.excluded_nuclei.collect()} == {("no nucleus", "missing_nucleus_roi"), ("thin", "no_valid_nucleus_pixels")}
    assert a.combinations.count() == 152 and a.nuclear_combinations.count() == 38
    path = f"file://{tmp_path}/run"
    results.save(a, path, "slide", "now")
    assert runs.is_published(spark, path.replace("/run", "/none")) is False
    lines = [r.value for r in spark.read.text(f"{path}/combinations.csv").collect()]
    assert lines[0] == ",".join(results.COMBINATION_COLUMNS) and lines[1].startswith('"A",1,"inclusive","PA",')
    assert [line.split(",")[3] for line in lines[1:17:2]] == ['"PA"', '"NPN"', '"CPN"', '"PN"'] * 2
    back = results.read_table(spark, f"{path}/cells.csv").first()
    assert back["cell_id"] == "split" and back["A:nucleus_mean"] == "200.000000000" and back["x_source_px"] == "8.00000000000"
    with pytest.raises(FileExistsError):
        results.save(a, path, "slide", "now")
    runs._fs(spark, f"file://{tmp_path}/half/x")[0].mkdirs(runs._fs(spark, f"file://{tmp_path}/half")[1])
    (tmp_path / "half" / "INCOMPLETE").touch()
    accepted, skipped = tables.scan_catalogue(spark, f"file://{tmp_path}")
    assert [(r.imageName, r.status) for r in accepted.collect()] == [("slide", "complete")]
    assert [(r.path.rsplit("/", 1)[1], r.reason) for r in skipped.collect()] == [("half", "incomplete")]


def test_checks_find_faults(spark):
    rows = [("A", 1, "inclusive", 3, "all_measured_nuclei", 4), ("A", 1, "exact", 2, "all_measured_nuclei", 4), ("B", 2, "inclusive", 2, "all_measured_nuclei", 4), ("B", 2, "exact", 1, "all_measured_nuclei", 4),
            ("A+B", 3, "inclusive", 1, "all_measured_nuclei", 4), ("A+B", 3, "exact", 1, "all_measured_nuclei", 4), ("A", 1, "inclusive", 3, "positive:A", 3)]
    df = spark.createDataFrame(rows, "combination string, mask int, mode string, numerator long, denominator_type string, denominator long")
    assert validate.nuclear_problems(df, ["A", "B"], F.lit(4)).count() == 0
    assert [tuple(r) for r in validate.nuclear_problems(df, ["A", "B"], F.lit(3)).collect()] == [(0, "exact_over_population")]
    bad = df.withColumn("numerator", F.when(F.col("mask") == 3, 2).otherwise(F.col("numerator")))
    assert {r.problem for r in validate.nuclear_problems(bad, ["A", "B"], F.lit(9)).collect()} == {"inconsistent_counts"}
    cells = spark.createDataFrame([("a", 1.0, 1.0, 1, 1, 1, 2, 3, 5.0), ("a", 1.0, 1.0, 1, 1, 0, 0, 0, 5.0), ("b", 1.0, float("nan"), 0, 1, 9, 0, 9, 5.0)],
                                  "cell_id string, x double, y double, nucleus_pixels int, cytoplasm_pixels int, npn int, cpn int, pn int, m double")
    found = {(r.key, r.rule) for r in validate.cell_problems(cells, 2, ["m"]).collect()}
    assert found == {("a", "unique_id"), ("b", "masks_in_range"), ("b", "compartments_have_pixels"), ("b", "finite_numbers")}
    files = spark.createDataFrame([("a", bytearray(b"1")), ("b", bytearray(b"2"))], "path string, content binary")
    assert validate.snapshot_problems(files, files).count() == 0 and [tuple(r) for r in validate.snapshot_problems(files, files.where("path = 'a'")).collect()] == [("b", "missing")]
    plan = spark.createDataFrame([("t", 1)], "task string, roi int")
    assert [(r.task, r.side) for r in validate.plan_differences(plan, plan.withColumn("roi", F.lit(2))).collect()] == [("t", "planned"), ("t", "journal")]
    r = ring(0, 0, 4, 4)
    objects_ = spark.createDataFrame([("cell", r, [*r[2:], *r[:2]]), ("cell", r, None), ("cell", None, r), ("other", None, None)], f"kind string, cell {geometry.RING}, nucleus {geometry.RING}")
    assert tuple(validate.output_audit(objects_).first()) == (4, 3, 1, 1, 1)


def test_queue(spark, tmp_path):
    done, journal = set(), f"file://{tmp_path}/journal.json"
    save = lambda attempts: runs.replace_file(spark, journal, json.dumps(attempts))

    def execute(task, directory):
        if task == "bad":
            raise RuntimeError("broken")
        if task == "stop":
            raise batch.Cancelled("told to")
        done.add((task, directory))

    old = [{"task": "a", "directory": "attempt-1", "status": "complete", "message": ""}, {"task": "b", "directory": "attempt-2", "status": "running", "message": ""}]
    out = batch.run_queue(["a", "b", "bad", "c", "stop", "never"], old, execute, lambda t, d: (t, d) in done, save)
    assert [(a["task"], a["status"]) for a in out] == [("a", "invalid"), ("b", "interrupted"), ("a", "complete"), ("b", "complete"), ("bad", "failed"), ("c", "complete"), ("stop", "cancelled")]
    assert json.loads((tmp_path / "journal.json").read_text()) == out and len({a["directory"] for a in out}) == len(out)
    again = batch.run_queue(["a", "b"], out, execute, lambda t, d: (t, d) in done, save)
    assert again == out


def test_exports(spark, tmp_path):
    pixels, _, _ = fixture(spark)
    stats = {(r.level, r.channel): r for r in export.export_channels(pixels.withColumn("level", F.lit(0)), ["A", "B"], f"file://{tmp_path}/raw").collect()}
    assert (stats[0, "A"].n, stats[0, "A"].min, stats[0, "A"].max, stats[0, "A"].mean) == (256, 20.0, 200.0, 110.0) and stats[0, "A"].sha256 != stats[0, "B"].sha256
    scaled = [(F.col(c) / 200.0) for c in "AB"]
    figures = export.publish_composites(pixels, scaled, [(255, 0, 0), (0, 255, 0)], ["A", "B"], f"file://{tmp_path}/figures").orderBy("sequence").collect()
    assert [(r.sequence, r["mask"], r.combination, r.pixels) for r in figures] == [(1, 3, "A+B", 256), (2, 1, "A", 256), (3, 2, "B", 256)]
    codes = pixels.select(F.floor("x").alias("px"), F.floor("y").alias("py"), F.when(F.col("x") < 16, 1).otherwise(2).alias("code"))
    masks.write_tiles(codes, 4, f"file://{tmp_path}/masks")
    contents, index = (spark.read.parquet(f"file://{tmp_path}/masks/{n}") for n in ("contents", "index"))
    assert (contents.count(), index.count()) == (2, 16) and {r.constant for r in contents.collect()} == {1, 2}
    seen = masks.consume(codes, lambda b: b.groupby("code", as_index=False).size().rename(columns={"size": "n"}), "code int, n long").groupBy("code").sum("n").collect()
    assert {tuple(r) for r in seen} == {(1, 128), (2, 128)}
