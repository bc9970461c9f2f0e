"""Versioned loads: broken ones change nothing, readers always get one consistent star."""

import pytest
from pyspark.sql import functions as F
from test_warehouse import staging

from lumbung.operators import dimensions, explorer, quality, star
from lumbung.plans import daily, warehouse
from lumbung.plans.warehouse import build_warehouse, cube_of, load_warehouse, read_warehouse
from lumbung.session import shared_folder, stage, stage_path, staging_area
from lumbung.sources import readers, sinks, versions


@pytest.fixture(scope="module")
def tables(spark):
    built = build_warehouse(staging(spark))
    return {name: stage(built[name], name) for name in (*star.DIMENSION_COLUMNS, sinks.FACT)}


def doubled(tables):
    """The same star with other sums."""
    return {**tables, sinks.FACT: tables[sinks.FACT].withColumn("sum_vol_mutasi", F.col("sum_vol_mutasi") * 2 + 1)}


def seen(spark, folder):
    """What a reader gets: rows of each table, and the sum that tells the versions apart."""
    star_ = read_warehouse(spark, folder)
    direct = {name: readers.read_parquet(spark, folder, name) for name in star_}
    counts = {name: df.count() for name, df in star_.items()}
    assert counts == {name: df.count() for name, df in direct.items()}
    return counts, cube_of(star_).agg(F.sum("sum_vol_mutasi")).first()[0]


STEPS = [
    (sinks, "load_table", "dim_prov"), (sinks, "load_table", "dim_komoditas"), (sinks, "load_table", "dim_waktu"),
    (sinks, "load_fact", None), (quality, "warehouse_report", None), (quality, "require_clean", None), (versions, "publish", None),
]


@pytest.mark.parametrize("step", STEPS, ids=lambda s: s[2] or s[1])
@pytest.mark.parametrize("when", ["before", "after"])
def test_a_load_that_breaks_changes_nothing(spark, tables, monkeypatch, step, when):
    folder = stage_path(spark, "dwh")
    load_warehouse(tables, folder)
    before = seen(spark, folder)
    module, name, table = step
    real = getattr(module, name)

    def broken(*args, **kwargs):
        if table is None or table in args:
            if when == "after":
                real(*args, **kwargs)
            raise OSError("lost")
        return real(*args, **kwargs)

    with monkeypatch.context() as patched:
        patched.setattr(module, name, broken)
        with pytest.raises(OSError, match="lost"):
            load_warehouse(doubled(tables), folder)
    if name == "publish" and when == "after":
        assert seen(spark, folder) != before and versions.current(spark, folder).number == 2
    else:
        assert seen(spark, folder) == before and versions.current(spark, folder).number == 1
    load_warehouse(doubled(tables), folder)
    assert seen(spark, folder)[1] == 2 * before[1] + before[0][sinks.FACT]


def test_a_pointer_that_is_cut_short_does_not_count(spark, tables):
    folder = stage_path(spark, "dwh")
    load_warehouse(tables, folder)
    files, path = versions._files(spark, folder)
    for text in (b"", b'{"dim_prov": "versions/x'):
        stream = files.create(path(f"{folder}/pointers/{versions._numbers(spark, folder)[0] + 1:012d}"), False)
        stream.write(bytearray(text))
        stream.close()
        assert versions.current(spark, folder).number == 1
    load_warehouse(doubled(tables), folder)
    assert versions.current(spark, folder).number == 4 and versions.read_version(spark, folder, 2) is None
    assert read_warehouse(spark, folder, 1)[sinks.FACT].count() == 6
    with pytest.raises(readers.TableNotFound):
        read_warehouse(spark, folder, 3)


def test_two_loads_at_once(spark, tables, monkeypatch):
    folder = stage_path(spark, "dwh")
    real = quality.require_clean

    def meanwhile(report):
        monkeypatch.setattr(quality, "require_clean", real)
        load_warehouse(doubled(tables), folder)  # another load is published first
        real(report)

    monkeypatch.setattr(quality, "require_clean", meanwhile)
    with pytest.raises(versions.LoadConflict):
        load_warehouse(tables, folder)
    assert versions.current(spark, folder).number == 1
    with pytest.raises(versions.LoadConflict):
        versions.publish(spark, folder, versions.Version(0, {}), after=0)


def test_old_versions_go(spark, tables):
    folder = stage_path(spark, "dwh")
    for star_ in (tables, doubled(tables), tables):
        load_warehouse(star_, folder)
    stray = versions.new_load()
    sinks.load_table(tables["dim_prov"], f"{folder}/{stray}", "dim_prov")
    assert versions.drop_old(spark, folder, keep=2) == []  # all are young
    assert versions._numbers(spark, folder) == [3, 2]
    gone = versions.drop_old(spark, folder, keep=2, hours=-1)
    assert len(gone) == 2 and stray.split("/")[1] in gone
    assert read_warehouse(spark, folder, 2)[sinks.FACT].count() == read_warehouse(spark, folder)[sinks.FACT].count() == 6


def months_written(spark, folder, version):
    place = version.tables[sinks.FACT]
    return sorted(name.split("=")[1] for name in entries(spark, f"{folder}/{place}") if "=" in name)


def test_only_changed_months_are_written(spark, tables):
    """A second load with one changed year writes that year's months, and equals a full load."""
    folder, fact = stage_path(spark, "dwh"), tables[sinks.FACT]
    load_warehouse(tables, folder)
    first = versions.current(spark, folder)
    every = sorted({str(r.waktu_key) for r in fact.collect()})
    assert months_written(spark, folder, first) == every
    other = stage(fact.withColumn("avg_harga", F.when(F.col("waktu_key") > 12, F.col("avg_harga") + 1).otherwise(F.col("avg_harga"))), "other")
    loaded = load_warehouse({**tables, sinks.FACT: other}, folder)
    second = versions.current(spark, folder)
    later = [m for m in every if int(m) > 12]
    assert months_written(spark, folder, second) == later and 0 < len(later) < len(every)
    assert len(second.parts[sinks.FACT]) == 2
    rows = lambda df: sorted(map(tuple, df.collect()), key=str)
    assert rows(loaded[sinks.FACT]) == rows(star.align(other)) == rows(readers.read_parquet(spark, folder, sinks.FACT).select(*star.FACT_TYPES))
    assert rows(read_warehouse(spark, folder, 1)[sinks.FACT]) == rows(star.align(fact))
    # A month that is gone, nothing new at all, and a month without rows before.
    gone = {**tables, sinks.FACT: other.where(F.col("waktu_key") != int(every[0]))}
    assert rows(load_warehouse(gone, folder)[sinks.FACT]) == rows(star.align(gone[sinks.FACT]))
    assert months_written(spark, folder, versions.current(spark, folder)) == []
    assert rows(load_warehouse({**tables, sinks.FACT: other}, folder)[sinks.FACT]) == rows(star.align(other))
    assert months_written(spark, folder, versions.current(spark, folder)) == [every[0]]
    # What a kept version still names is not deleted.
    versions.drop_old(spark, folder, keep=1, hours=-1)
    assert rows(read_warehouse(spark, folder)[sinks.FACT]) == rows(star.align(other))
    year = cube_of(read_warehouse(spark, folder)).where("tahun = 2025")
    assert year.count() == 2 and "dynamicpruning" in year._jdf.queryExecution().executedPlan().toString()


def test_a_table_in_many_folders_is_written_anew():
    sums = {str(i): "x" for i in range(20)}
    old = versions.Version(3, {"t": "a"}, {"t": {f"l{i}": [str(i)] for i in range(9)}}, {"t": sums}, {"t": "m"})
    assert versions.changed(old, "t", sums, "new", most=20) == (sorted(str(i) for i in range(9, 20)), {**old.parts["t"], "new": sorted(str(i) for i in range(9, 20))})
    assert versions.changed(old, "t", sums, "new", most=8) == (sorted(sums), {"new": sorted(sums)})
    assert versions.changed(None, "t", {}, "new") == ([], {"new": []})


def test_checksums_do_not_depend_on_order(spark):
    rows = [(i % 3 or None, float(i), None if i % 4 else "x") for i in range(50)]
    one, two = (spark.createDataFrame(r, "m int, a double, b string") for r in (rows, rows[::-1]))
    sums = sinks.checksums(one.repartition(3), "m")
    assert sums == sinks.checksums(two, "m") and set(sums) == {"1", "2", "null"}
    moved = spark.createDataFrame([(m, a, "x" if b is None and a == 1 else b) for m, a, b in rows], "m int, a double, b string")
    again = sinks.checksums(moved, "m")
    assert {k for k in sums if sums[k] != again[k]} == {"1"}
    assert sinks.checksums(one.unionByName(one), "m") != sums


def test_filters_on_months_reach_the_fact(spark, tables):
    """A year's slice reads the folders of its months only, also through a filter on the dimension."""
    folder = stage_path(spark, "dwh")
    cube = cube_of(load_warehouse(tables, folder))
    for rows in (explorer.slice_year(cube, 2025), cube.where("nama_bulan = 'Januari'")):
        rows.collect()
        plan = rows._jdf.queryExecution().executedPlan()
        assert "dynamicpruning" in plan.toString()
        found = [n for n in leaves(plan) if "dynamicpruning" in n.toString()]
        read = found[0].metrics().get("numPartitions").get().value()
        months = cube.select("waktu_key").distinct().count()
        assert len(found) == 1 and 0 < read < months


def leaves(plan):
    """Leaf nodes of a plan that ran, with what adaptive execution put in."""
    name = plan.getClass().getSimpleName()
    if name == "AdaptiveSparkPlanExec":
        return leaves(plan.executedPlan())
    if name.endswith("QueryStageExec"):
        return leaves(plan.plan())
    children = plan.children()
    if children.isEmpty():
        return [plan]
    return [leaf for i in range(children.size()) for leaf in leaves(children.apply(i))]


def test_the_gate_reads_the_fact_twice_at_most(spark, tables, monkeypatch):
    fact, dims = tables[sinks.FACT], [tables[n] for n in ("dim_prov", "dim_komoditas", "dim_waktu")]
    staged = []
    monkeypatch.setattr(quality, "stage", lambda df, name: staged.append(name) or stage(df, name))
    plain = quality.warehouse_report(fact, *dims)
    counted = {"rows": 6, "null_prov_key": 0, "null_waktu_key": 0, "null_komoditas_key": 0}
    again = quality.warehouse_report(fact, *dims, counted=counted)
    assert staged == ["fact-keys"] * 2  # one pass each, and one for the counts if none are given
    place = fact.inputFiles()[0].rsplit("/", 2)[-2]
    assert place not in again._jdf.queryExecution().executedPlan().toString()
    assert sorted(map(tuple, plain.collect())) == sorted(map(tuple, again.collect()))


def test_counts_are_taken_while_the_fact_is_written(spark, tables):
    fact = tables[sinks.FACT].withColumn("prov_key", F.when(F.col("komoditas_key") == 1, F.col("prov_key")))
    counted = sinks.load_fact(fact, stage_path(spark, "dwh"), sinks.FACT, "waktu_key", quality.fact_counts(fact))
    assert counted == {"rows": 6, "null_prov_key": 4, "null_waktu_key": 0, "null_komoditas_key": 0}


def entries(spark, folder):
    files, path = versions._files(spark, folder)
    return [s.getPath().getName() for s in files.listStatus(path(folder))] if files.exists(path(folder)) else []


def test_staged_tables_of_a_job_go(spark):
    outside = stage(spark.range(3), "outside")
    with staging_area(spark) as area:
        stage(spark.range(2), "a")
        with staging_area(spark) as inner:
            stage(spark.range(2), "b")
            assert entries(spark, inner) and inner.startswith(area)
        assert not entries(spark, inner) and entries(spark, area)
    assert not entries(spark, area) and outside.count() == 3
    with pytest.raises(ValueError), staging_area(spark) as area:
        stage(spark.range(2), "c")
        raise ValueError
    assert not entries(spark, area)


def test_daily_runs_leave_nothing_staged_and_keep_keys(spark, monkeypatch):
    """The second run knows a region more, whose name comes first; the old keys stay."""
    folder, tables = stage_path(spark, "daily"), staging(spark)
    source = {**tables, "bps_dummy_raw": tables["bps_dummy_raw"], "tr_hasil_lab": spark.range(0)}
    monkeypatch.setattr(daily, "staging_tables", lambda spark, place: source)
    root = f"{shared_folder(spark)}/lumbung/{spark.sparkContext.applicationId}"
    before = {n for n in entries(spark, root) if n.startswith("job-")}
    first = daily.run_daily(spark, "-", f"{folder}/output", f"{folder}/dwh", f"{folder}/cube")
    keys = {r.nama_provinsi: r.prov_key for r in first["dim_prov"].collect()}
    months = {(r.tahun, r.bulan): r.waktu_key for r in first["dim_waktu"].collect()}
    more = source["bps_api_raw"].where("provinsi = 'Bali'").withColumn("provinsi", F.lit("Aaceh"))
    earlier = source["bps_api_raw"].where("provinsi = 'Aceh' AND tahun = '2024'").withColumn("tahun", F.lit("2023"))
    substitute = source["bps_dummy_raw"].where("provinsi = 'Aceh' AND tahun = 2024").withColumn("tahun", F.lit(2023).cast(source["bps_dummy_raw"].schema["tahun"].dataType))
    names = source["ref_wilayah"].limit(1).withColumn("provinsi", F.lit("Aaceh")).withColumn("id_wilayah", F.lit(77).cast(source["ref_wilayah"].schema["id_wilayah"].dataType))
    source = {
        **source, "bps_api_raw": source["bps_api_raw"].unionByName(more).unionByName(earlier),
        "ref_wilayah": source["ref_wilayah"].unionByName(names), "bps_dummy_raw": source["bps_dummy_raw"].unionByName(substitute),
    }
    second = daily.run_daily(spark, "-", f"{folder}/output", f"{folder}/dwh")
    again = {r.nama_provinsi: r.prov_key for r in second["dim_prov"].collect()}
    later = {(r.tahun, r.bulan): r.waktu_key for r in second["dim_waktu"].collect()}
    assert {n: again[n] for n in keys} == keys and len(again) > len(keys) and len(set(again.values())) == len(again)
    assert {m: later[m] for m in months} == months and len(later) == 36 and sorted(later.values()) == list(range(1, 37))
    assert sorted((r.prov_key, r.waktu_key) for r in read_warehouse(spark, f"{folder}/dwh", 1)[sinks.FACT].collect()) == sorted(
        (r.prov_key, r.waktu_key) for r in second[sinks.FACT].collect()
    )
    monkeypatch.setattr(warehouse.versions, "publish", lambda *a: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        daily.run_daily(spark, "-", f"{folder}/output", f"{folder}/dwh")
    assert {n for n in entries(spark, root) if n.startswith("job-")} == before


def test_new_keys_are_numbered_in_parallel(spark):
    known = spark.createDataFrame([(f"n{i:04d}", 5000 - i) for i in range(0, 1000, 3)], "name string, k int")
    names = spark.createDataFrame([(f"n{i:04d}",) for i in range(1000)] * 2, "name string").repartition(7)
    got = {r.name: r.k for r in dimensions.with_lasting_keys(names, ["name"], "k", known).collect()}
    want = {f"n{i:04d}": 5000 - i for i in range(0, 1000, 3)}
    new = [f"n{i:04d}" for i in range(1000) if i % 3]
    assert got == want | {n: 5001 + i for i, n in enumerate(new)}
    none = dimensions.with_lasting_keys(names, ["name"], "k", known.limit(0))
    assert sorted(r.k for r in none.collect()) == list(range(1, 1001))
