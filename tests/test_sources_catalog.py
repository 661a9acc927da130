"""File sources through the ingest path, catalog views, profile, paths."""

from pyspark.sql import functions as F

from strata.operators.profile import profile
from strata.paths import bronze_location, dataset_location
from strata.plans.staging import stg_drivers
from strata.sources import catalog
from strata.sources.files import file_reader, read_files, templated_file_reader, write_files
from strata.sources.ingest import load_bronze, read_bronze
from strata.specs import Dataset, SourceSpec


def test_paths(monkeypatch):
    assert dataset_location("marts", "f1", "m", "/r") == "/r/marts/f1/m.parquet"
    monkeypatch.setenv("LAKEHOUSE_DATA_ROOT", "/env")
    assert dataset_location("staging", "f1", "s") == "/env/staging/f1/s.parquet"
    monkeypatch.delenv("LAKEHOUSE_DATA_ROOT")
    assert dataset_location("staging", "f1", "s") == "../data/staging/f1/s.parquet"
    assert bronze_location("f1", "raw", "/r") == "/r/raw/f1/raw.slices"


def test_unpartitioned_file_dataset(spark, scratch):
    """A CSV source without partitions: each load replaces the whole table."""
    src = f"{scratch}/drivers_csv"
    rows = [("ver", "33", "VER", "Max", "Verstappen", "1997-09-30", "Dutch", "u1")]
    ddl = ("driverId string, permanentNumber string, code string, givenName string, familyName string, "
           "dateOfBirth string, nationality string, url string")
    write_files(spark.createDataFrame(rows, ddl), "csv", src, header=True)
    ds = Dataset("files", (SourceSpec("raw_drivers", file_reader("csv", src, ddl, header=True)),))
    load_bronze(spark, ds, root=f"{scratch}/lake")
    more = rows + [("ham", "44", "HAM", "Lewis", "Hamilton", "1985-01-07", "British", "u2")]
    write_files(spark.createDataFrame(more, ddl), "csv", src, header=True)
    load_bronze(spark, ds, root=f"{scratch}/lake")
    raw = read_bronze(spark, ds, f"{scratch}/lake")["raw_drivers"]
    assert sorted(r["driverId"] for r in raw.collect()) == ["ham", "ver"]
    typed = stg_drivers(raw.withColumn("season", F.lit("2024")))
    assert {r["driver_id"]: r["permanent_number"] for r in typed.collect()} == {"ver": 33, "ham": 44}
    again = read_files(spark, "csv", src, ddl, header=True)
    assert again.count() == 2


def test_views_external_tables_and_cache(spark, scratch):
    df = spark.createDataFrame([(2024, "a", 3.0), (2023, "b", 1.0)], "season int, k string, v double")
    path = catalog.materialise(df, f"{scratch}/gold/m.parquet", partition_by=("season",))
    catalog.register(spark, "m_view", path)
    got = spark.sql("SELECT k FROM m_view WHERE season = :s", args={"s": 2024}).collect()
    assert [r["k"] for r in got] == ["a"]
    ext = catalog.register_external(spark, "m_ext", path)
    assert ext.count() == 2
    served = catalog.serving_view(spark, "m_served", path, cache=True)
    assert spark.catalog.isCached("m_served") and served.count() == 2
    spark.catalog.uncacheTable("m_served")
    assert catalog.read_model(spark, path).filter("season = 2023").count() == 1


def test_profile(spark):
    df = spark.createDataFrame([(1, None), (None, "x")], "a int, b string")
    p = profile(df, sample_rows=1)
    assert [f.name for f in p.schema.fields] == ["a", "b"]
    assert p.rows.first()["row_count"] == 2
    assert p.nulls.first().asDict() == {"a": 1, "b": 1}
    assert p.sample.count() == 1


def test_partition_templated_file_source(spark, scratch):
    """CSV folders per season behind a ``{partition}`` template, loaded as slices."""
    ddl = "driverId string, nationality string"
    for season, rows in {"2023": [("a", "X")], "2024": [("b", "Y"), ("c", "Z")]}.items():
        write_files(spark.createDataFrame(rows, ddl), "csv", f"{scratch}/in/{season}", header=True)
    reader = templated_file_reader("csv", f"{scratch}/in/{{partition}}", ddl, header=True)
    ds = Dataset("files", (SourceSpec("raw_drivers", reader, partition_column="season"),), partitions=("2023", "2024"))
    load_bronze(spark, ds, root=f"{scratch}/lake")
    raw = read_bronze(spark, ds, f"{scratch}/lake")["raw_drivers"]
    assert sorted((r["season"], r["driverId"]) for r in raw.collect()) == [("2023", "a"), ("2024", "b"), ("2024", "c")]
    # reload one key only: the other slice is untouched
    write_files(spark.createDataFrame([("d", "W")], ddl), "csv", f"{scratch}/in/2024", header=True)
    load_bronze(spark, ds, keys=["2024"], root=f"{scratch}/lake")
    raw = read_bronze(spark, ds, f"{scratch}/lake")["raw_drivers"]
    assert sorted((r["season"], r["driverId"]) for r in raw.collect()) == [("2023", "a"), ("2024", "d")]
