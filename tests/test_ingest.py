import datetime

import pytest

from punctual import schema
from punctual.session import scratch_path
from punctual.sources import csv_files
from punctual.sources.warehouse import Warehouse

HEADER = (
    "Type,Order Id,Order Item Id,order date (DateOrders),shipping date (DateOrders),"
    "Shipping Mode,Days for shipping (real),Late_delivery_risk,Order Country,Order Region,"
    "Product Name,Sales,Unused"
)
LINES = [
    'DEBIT,1,11,1/31/2018 22:56,2/3/2018 22:56,Standard Class,3,0,México,South of  USA ,'
    '"Ball, ""big""",327.75,x',
    "CASH,2,12,not a date,2/3/2018 0:05,First Class,abc,1,Peru,NA,Bat,,y",
]


@pytest.fixture
def csv(tmp_path):
    path = tmp_path / "raw.csv"
    path.write_text("\n".join([HEADER, *LINES]) + "\n", encoding="latin-1")
    return str(path)


def test_csv_text_dates_and_types(spark, csv):
    with pytest.warns(UserWarning, match="Market"):
        df = csv_files.load_csv(spark, csv)
    assert df.columns == schema.STAGING_COLUMNS
    first, second = df.orderBy("order_id").collect()
    assert first["order_country"] == "México"
    assert first["order_region"] == "South of  USA "
    assert first["product_name"] == 'Ball, "big"'
    assert first["order_date"] == datetime.date(2018, 1, 31)
    assert first["payment_type"] == "DEBIT"
    assert float(first["sales"]) == 327.75
    assert first["market"] is None and first["row_id"] is None
    assert second["order_date"] is None and second["days_for_shipping_real"] is None
    assert second["shipping_date"] == datetime.date(2018, 2, 3)
    # Only an empty field is null; the text NA is a value.
    assert second["order_region"] == "NA" and second["sales"] is None
    with pytest.warns(UserWarning):
        strict = csv_files.load_csv(spark, csv, null_texts=["NA", "NULL"])
    assert strict.filter("order_region is null").count() == 1


def test_missing_headers_are_listed_or_raised(spark, csv):
    raw = csv_files.read_csv(spark, csv)
    with pytest.warns(UserWarning):
        missing = csv_files.missing_headers(raw)
    assert "Customer Id" in missing and "Sales" not in missing
    with pytest.raises(ValueError, match="Customer Id"):
        csv_files.missing_headers(raw, strict=True)


def test_quoted_line_breaks_stay_in_their_field(spark, staging):
    rows = staging({"product_name": 'two\nlines, "quoted"\r\nthree'}, {"order_id": 2})
    path = scratch_path(spark, "csv")
    csv_files.write_csv(rows, path)
    back = csv_files.load_csv(spark, path)
    assert back.count() == 2
    names = {r["product_name"].replace("\r\n", "\n") for r in back.collect()}
    assert names == {'two\nlines, "quoted"\nthree', "Ball"}


def test_large_and_long_amounts_are_kept(spark, tmp_path):
    path = tmp_path / "raw.csv"
    path.write_text("Order Id,Sales\n1,1000000000.50\n2,1.1234567891234\n9999999999,3\n")
    with pytest.warns(UserWarning):
        rows = csv_files.load_csv(spark, str(path)).collect()
    assert [str(r["sales"].normalize()) for r in rows] == ["1000000000.5", "1.1234567891234", "3"]
    assert rows[2]["order_id"] == 9999999999


def test_the_report_counts_what_is_lost(spark, tmp_path):
    path = tmp_path / "raw.csv"
    path.write_text(
        "Order Id,order date (DateOrders),Sales,Order Item Quantity\n"
        "1,2018-01-31,1.5,2\nx,1/31/2018 22:56,1.0000000000000000001,9999999999\n"
        "3,,2\n4,1/31/2018 22:56,7,8,9\n")
    raw = csv_files.read_csv(spark, str(path))
    got = {r["column_name"]: tuple(r)[2:] for r in csv_files.load_report(raw).collect()}
    assert got == {
        "order_id": (4, 1, 0), "order_date": (3, 1, 0), "sales": (4, 0, 1),
        "order_item_quantity": (3, 1, 0), csv_files.MALFORMED: (2, 2, 0)}
    by_pattern = csv_files.load_report(raw, date_pattern="yyyy-MM-dd").collect()
    assert {r["column_name"]: r["n_unparsed"] for r in by_pattern}["order_date"] == 2


def test_dates_of_another_format(spark, tmp_path):
    path = tmp_path / "raw.csv"
    path.write_text("Order Id,order date (DateOrders)\n1,2018-01-31\n")
    with pytest.warns(UserWarning):
        row = csv_files.load_csv(spark, str(path), date_pattern="yyyy-MM-dd").first()
    assert row["order_date"] == datetime.date(2018, 1, 31)


def test_strict_loading_raises_on_lost_values(spark, staging, tmp_path):
    path = scratch_path(spark, "csv")
    csv_files.write_csv(staging({}), path)
    assert csv_files.load_csv(spark, path, strict=True).count() == 1
    with pytest.raises(ValueError, match="order_date"):
        csv_files.load_csv(spark, path, strict=True, date_pattern="yyyy-MM-dd")


def test_csv_round_trip(spark, staging):
    rows = staging({"order_city": "São Paulo", "product_name": 'a "b", c'}, {"order_id": 2})
    path = scratch_path(spark, "csv")
    csv_files.write_csv(rows, path)
    assert csv_files.load_csv(spark, path).exceptAll(rows).count() == 0


def test_append_and_overwrite(spark, staging):
    house = Warehouse(spark, scratch_path(spark, "w"))
    rows = staging({}, {"order_id": 2})
    house.write("stg_orders", rows)
    house.write("stg_orders", rows)
    assert house.table("stg_orders").count() == 2
    assert house.append("stg_orders", rows).count() == 4


def test_a_table_may_be_replaced_by_a_change_of_itself(spark, staging):
    house = Warehouse(spark, scratch_path(spark, "w"))
    house.write("t", staging({}, {"order_id": 2}))
    before = house.table("t")
    assert house.write("t", before.filter("order_id = 2")).count() == 1
    assert before.count() == 2


def test_readers_see_the_last_published_version(spark, staging):
    root = scratch_path(spark, "w")
    first = Warehouse(spark, root)
    first.write("t", staging({}))
    first.publish()
    second = Warehouse.open(spark, root)
    second.write("t", staging({}, {}))
    assert Warehouse.open(spark, root).table("t").count() == 1
    second.publish()
    assert Warehouse.open(spark, root).table("t").count() == 2


def test_nothing_published_is_an_error(spark, tmp_path):
    with pytest.raises(Exception):
        Warehouse.open(spark, str(tmp_path))


def test_scratch_folder_is_the_configured_one(spark):
    from punctual.session import scratch_root

    assert scratch_root(spark) == spark.conf.get("spark.checkpoint.dir")


def test_a_cluster_must_name_its_scratch_folder():
    from types import SimpleNamespace

    from punctual.session import scratch_root

    cluster = SimpleNamespace(
        sparkContext=SimpleNamespace(master="spark://host:7077"),
        conf=SimpleNamespace(get=lambda key, default: default),
    )
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        scratch_root(cluster)


def test_shuffles_grow_with_the_input_and_only_inside_the_block(spark):
    from punctual.session import sized_shuffles

    key = "spark.sql.shuffle.partitions"
    before = spark.conf.get(key)
    for size, partitions in [(2**20, int(before)), (100 * 2**30, 1600), (100 * 2**40, 1_638_400)]:
        with sized_shuffles(spark, size):
            assert int(spark.conf.get(key)) == partitions
        assert spark.conf.get(key) == before


def test_profile_counts_values_by_column(spark, staging):
    from punctual.plans.quality import profile

    got = {r["column_name"]: r for r in profile(staging({}, {"order_city": None})).collect()}
    assert got["order_city"]["n_non_null"] == 1 and got["order_city"]["n_rows"] == 2
    assert got["order_date"]["data_type"] == "date"
    assert got["row_id"]["n_non_null"] == 0


def test_written_files_are_compressed_and_small(spark, staging, tmp_path, monkeypatch):
    """Compressed files are read by one task each, so their rows are bounded."""
    monkeypatch.setattr(csv_files, "FILE_ROWS", 3)
    rows = staging(*[
        {"order_id": i, "order_item_id": i, "product_name": f'n{i}\n"q", é'} for i in range(10)
    ]).coalesce(1)
    path = str(tmp_path / "out")
    csv_files.write_csv(rows, path)
    files = [p.name for p in (tmp_path / "out").iterdir() if p.name.startswith("part-")]
    assert len(files) == 4 and all(f.endswith(".csv.gz") for f in files)
    back = csv_files.load_csv(spark, path, schema=rows.schema)
    assert sorted((r["order_id"], r["product_name"]) for r in back.collect()) == [
        (i, f'n{i}\n"q", é') for i in range(10)]
