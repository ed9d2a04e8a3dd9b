import csv
import io
import random

import pytest

from helpers import date, rows
from silverlode import Warehouse
from silverlode.schemas import BRONZE, EXTRACTS, Extract
from silverlode.sources import LoadFailed, read_extract, split_rejects

CUSTOMERS = BRONZE["crm_cust_info"]
HEADER = "cst_id,cst_key,cst_firstname,cst_lastname,cst_marital_status,cst_gndr,cst_create_date"


def write(folder, name, text):
    path = folder / name
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes(text.encode())
    return str(path)


def good(spark, path, schema=CUSTOMERS, **options):
    return rows(split_rejects(read_extract(spark, path, schema, **options))[0])


def test_quotes_blanks_and_padding(spark, tmp_path):
    path = write(tmp_path, "a.csv", HEADER + "\n"
                 '1,K1," Ann, the ""first""",Lee ,S,F,2025-01-02\n'
                 "2,K2,,Ray,,,\n"
                 ',"",x,y,M,M,2025-01-03\n')
    assert good(spark, path) == sorted([
        (1, "K1", ' Ann, the "first"', "Lee ", "S", "F", date("2025-01-02")),
        (2, "K2", None, "Ray", None, None, None),
        (None, "", "x", "y", "M", "M", date("2025-01-03")),
    ], key=repr)


def test_windows_line_ends(spark, tmp_path):
    path = write(tmp_path, "a.csv", "ID,CAT,SUBCAT,MAINTENANCE\r\nAC_BR,Acc,Racks,Yes\r\nAC_BS,Acc,Stands,No\r\n")
    assert good(spark, path, BRONZE["erp_px_cat_g1v2"]) == [
        ("AC_BR", "Acc", "Racks", "Yes"), ("AC_BS", "Acc", "Stands", "No"),
    ]


def test_columns_bind_by_position(spark, tmp_path):
    path = write(tmp_path, "a.csv", "SOME,OTHER,NAMES,HERE\na,b,c,d\n")
    assert good(spark, path, BRONZE["erp_px_cat_g1v2"]) == [("a", "b", "c", "d")]


def test_unquoted_extract_keeps_quotes(spark, tmp_path):
    path = write(tmp_path, "a.csv", 'CID,BDATE,GEN\nNAS"1",1970-01-01,"M"\n"AW2,,F\n')
    assert good(spark, path, BRONZE["erp_cust_az12"], quoted=False) == sorted([
        ('NAS"1"', date("1970-01-01"), '"M"'), ('"AW2', None, "F"),
    ], key=repr)


def test_line_breaks_inside_fields(spark, tmp_path):
    path = write(tmp_path, "a.csv", 'id,cat,subcat,maintenance\na,"two\nlines",c,d\n')
    schema = BRONZE["erp_px_cat_g1v2"]
    assert good(spark, path, schema) == [("a", "two\nlines", "c", "d")]


def test_bad_lines_are_set_aside(spark, tmp_path):
    path = write(tmp_path, "a.csv", HEADER + "\n"
                 "1,K1,a,b,S,F,2025-01-02\n"
                 "x,K2,a,b,S,F,2025-01-02\n"
                 "3,K3,a,b,S,F,2025-13-02\n"
                 "4,K4\n")
    read = read_extract(spark, path, CUSTOMERS)
    kept, rejected = split_rejects(read)
    assert [row.cst_id for row in kept.collect()] == [1]
    assert sorted(row["_rejected_line"] for row in rejected.collect()) == [
        "3,K3,a,b,S,F,2025-13-02", "4,K4", "x,K2,a,b,S,F,2025-01-02",
    ]


def test_failfast_raises(spark, tmp_path):
    path = write(tmp_path, "a.csv", HEADER + "\nx,K2,a,b,S,F,2025-01-02\n")
    with pytest.raises(Exception, match="MALFORMED|Malformed"):
        read_extract(spark, path, CUSTOMERS, mode="FAILFAST").collect()


def extract_folder(tmp_path, bad_lines):
    write(tmp_path, "source_crm/cust_info.csv",
          HEADER + "\n1,K1,a,b,S,F,2025-01-02\n" + "x,,,,,,\n" * bad_lines)
    return str(tmp_path), [extract for extract in EXTRACTS if extract.table == "crm_cust_info"]


def test_load_counts_rejected_lines(job, tmp_path):
    folder, extracts = extract_folder(tmp_path, bad_lines=3)
    store = Warehouse(job)
    log = {row.table_name: row for row in store.load_extracts(folder, extracts, max_rejects=3).collect()}
    assert (log["crm_cust_info"].rows_loaded, log["crm_cust_info"].rows_rejected) == (1, 3)
    assert log["crm_cust_info"].status == "ok" and log["crm_cust_info"].seconds > 0
    assert log["(all)"].rows_loaded == 1
    assert store.bronze("crm_cust_info").count() == 1


def test_too_many_rejected_lines_fail_the_load(job, tmp_path):
    folder, extracts = extract_folder(tmp_path, bad_lines=11)
    store = Warehouse(job)
    store.load_bronze({"crm_cust_info": job.spark.createDataFrame(
        [(7, "K7", "a", "b", "S", "F", date("2025-01-02"))], CUSTOMERS)})
    with pytest.raises(LoadFailed):
        store.load_extracts(folder, extracts)
    failed = store.log.read().filter("status = 'failed'").collect()
    assert {(row.table_name, row.rows_rejected) for row in failed} == {
        ("crm_cust_info", 11), ("(all)", None),
    }
    assert all("11 rejected lines, 0 allowed" in row.message for row in failed)
    # The table of the last good load is still there, and the bad lines are kept.
    assert [row.cst_id for row in store.bronze("crm_cust_info").collect()] == [7]
    assert [row.line for row in store.rejects().collect()] == ["x,,,,,,"] * 11
    store.load_extracts(folder, extracts, max_rejects=None)
    assert max(row.rows_rejected for row in store.log.read().filter("status = 'ok'").collect() if row.rows_rejected is not None) == 11


def test_missing_extract_raises_and_is_logged(job, tmp_path):
    store = Warehouse(job)
    with pytest.raises(Exception, match="PATH_NOT_FOUND|does not exist"):
        store.load_extracts(str(tmp_path), [Extract("erp_loc_a101", "nothing.csv")])
    assert store.log.read().filter("status = 'failed'").count() == 2


def test_reload_replaces_and_log_grows(spark, job):
    store = Warehouse(job)
    first = spark.createDataFrame([("a", "x"), ("b", "y")], BRONZE["erp_loc_a101"])
    store.load_bronze({"erp_loc_a101": first})
    store.load_bronze({"erp_loc_a101": first.limit(1)})
    assert store.bronze("erp_loc_a101").count() == 1
    loads = store.log.read().filter("table_name = 'erp_loc_a101'").orderBy("finished_at")
    assert [row.rows_loaded for row in loads.collect()] == [2, 1]


def test_every_rejected_line_is_kept_with_its_file(job, tmp_path):
    text = HEADER + "\n1,K1,a,b,S,F,2025-01-02\n2,K2\nx,K3,a,\"b, c\",S,F,2025-01-02\n"
    write(tmp_path, "a.csv", text)
    store = Warehouse(job)
    store.load_extracts(str(tmp_path), [Extract("crm_cust_info", "a.csv")], max_rejects=2)
    kept = store.rejects().collect()
    assert sorted(row.line for row in kept) == ["2,K2", 'x,K3,a,"b, c",S,F,2025-01-02']
    assert {row.table_name for row in kept} == {"crm_cust_info"}
    assert all(row.file.endswith("a.csv") for row in kept)


def test_an_extract_of_bad_lines_alone_gives_an_empty_table(job, tmp_path):
    write(tmp_path, "a.csv", HEADER + "\nx,,,,,,\n")
    store = Warehouse(job)
    store.load_extracts(str(tmp_path), [Extract("crm_cust_info", "a.csv")], max_rejects=None)
    assert store.bronze("crm_cust_info").count() == 0 and store.rejects().count() == 1


def loaded(job, tmp_path, text):
    """Locations and rejected lines of a load that allows any number of rejects."""
    write(tmp_path, "a.csv", "cid,cntry\n" + text)
    extracts = [Extract("erp_loc_a101", "a.csv")]
    with pytest.raises(LoadFailed):
        Warehouse(job).load_extracts(str(tmp_path), extracts)
    store = Warehouse(job, f"{job.folder}/other")
    store.load_extracts(str(tmp_path), extracts, max_rejects=None)
    return rows(store.bronze("erp_loc_a101")), sorted(r.line for r in store.rejects().collect())


@pytest.mark.parametrize("text, kept, refused", [
    ('AW-1,"Uni\n', [], ['AW-1,"Uni']),
    ('"AW-1,x\nAW-2,y\n', [("AW-2", "y")], ['"AW-1,x']),
    ('AW-1,x\nAW-2,"y', [("AW-1", "x")], ['AW-2,"y']),
    # Two open quotes, which together look like one record, and whole lines after them.
    ('AW-1,"x\nAW-2,y\nAW-3,"z\nAW-4,"w"\n', [("AW-2", "y"), ("AW-4", "w")],
     ['AW-1,"x', 'AW-3,"z']),
    ('"AW-1,x\nAW-2,y\n"AW-3,z\n', [("AW-2", "y")], ['"AW-1,x', '"AW-3,z']),
    # An open quote before a record of two lines, which is still found.
    ('AW-1,"x\nAW-2,y\nAW-3,"Uni\nted"\n', [("AW-2", "y"), ("AW-3", "Uni\nted")],
     ['AW-1,"x']),
    # Quotes that neither open nor end a field.
    ('AW-1,5" wide\nAW-2,"a"b\nAW-3,"Uni\nted"\n', [("AW-3", "Uni\nted")],
     ['AW-1,5" wide', 'AW-2,"a"b']),
    ('AW-1,x"\nAW-2,y\n', [("AW-2", "y")], ['AW-1,x"']),
])
def test_an_unclosed_quote_spoils_its_own_line(job, tmp_path, text, kept, refused):
    assert loaded(job, tmp_path, text) == (kept, refused)


def test_two_open_quotes_in_three_columns(spark, tmp_path):
    path = write(tmp_path, "a.csv", 'cid,bdate,gen\n1,"abc,x\n2,b,y\n3,"def,z\n')
    schema = BRONZE["erp_px_cat_g1v2"]
    schema = type(schema)(schema.fields[:3])
    kept, rejected = split_rejects(read_extract(spark, path, schema))
    assert rows(kept) == [("2", "b", "y")]
    assert sorted(r["_rejected_line"] for r in rejected.collect()) == ['1,"abc,x', '3,"def,z']


def records_of(seed, size):
    """Random fields, many of them with quotes, commas and line breaks."""
    chance = random.Random(seed)
    parts = ["a", "b c", '"', '""', ",", "\n", "\r\n", "", "é", '\n"', '",', "x\n\ny"]
    return [
        tuple(["".join(chance.choices(parts, k=chance.randrange(6))) or "-" for _ in range(4)])
        for _ in range(size)
    ]


@pytest.mark.parametrize("seed, end", [(1, "\n"), (2, "\r\n"), (3, "\n")])
def test_one_file_is_read_by_many_tasks(spark, tmp_path, seed, end):
    """Records with line breaks, cut at any byte, are those that Python's reader gives."""
    written = records_of(seed, 3000)
    text = "".join(
        ",".join('"' + field.replace('"', '""') + '"' for field in record) + end
        for record in [("id", "cat", "subcat", "maintenance"), *written]
    )
    assert list(csv.reader(io.StringIO(text, newline="")))[1:] == [list(r) for r in written]
    path = write(tmp_path, "a.csv", text)
    spark.conf.set("spark.sql.files.maxPartitionBytes", 1500)
    spark.conf.set("spark.sql.files.openCostInBytes", 0)
    try:
        lines = spark.read.text(path)
        assert lines.rdd.getNumPartitions() > 20
        found = read_extract(spark, path, BRONZE["erp_px_cat_g1v2"])
        assert "FileScan csv" not in found._jdf.queryExecution().executedPlan().toString()
        kept, rejected = split_rejects(found)
        assert rejected.count() == 0
        assert rows(kept) == sorted(written, key=repr)
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_many_files_with_headers_of_their_own(spark, tmp_path):
    for name in "abc":
        write(tmp_path, f"in/{name}.csv", f'id,cat,subcat,maintenance\n{name},"1\n2",c,d\n{name},x,y,z\n')
    assert good(spark, str(tmp_path / "in"), BRONZE["erp_px_cat_g1v2"]) == sorted(
        [(name, "1\n2", "c", "d") for name in "abc"] + [(name, "x", "y", "z") for name in "abc"])


def test_lenient_numbers_and_dates(spark, tmp_path):
    path = write(tmp_path, "a.csv", HEADER + "\n"
                 ' 5 ,K1,a,b,S,F, 2003-07-01 00:00:00\n"",K2,a,b,S,F,""\n'
                 "6,K3,a,b,S,F,2003-07-01 10:00:00\n7.5,K4,a,b,S,F,2003\n")
    read = read_extract(spark, path, CUSTOMERS)
    kept, rejected = split_rejects(read)
    assert rows(kept.select("cst_id", "cst_key", "cst_create_date")) == [
        (5, "K1", date("2003-07-01")), (None, "K2", None),
    ]
    assert rejected.count() == 2


def test_only_current_and_last_versions_are_kept(spark, job):
    store = Warehouse(job)
    first = spark.createDataFrame([("a", "x")], BRONZE["erp_loc_a101"])
    held = None
    for _ in range(4):
        before, held = held, store.load_bronze({"erp_loc_a101": first}) and store.bronze("erp_loc_a101")
        if before is not None:
            assert before.count() == 1  # a query on the version before still runs
    assert len(store.files.names(f"{store.root}/bronze/erp_loc_a101")) == 2


def test_a_load_that_fails_halfway_publishes_nothing(spark, job, monkeypatch):
    store = Warehouse(job)
    first = spark.createDataFrame([("a", "x")], BRONZE["erp_loc_a101"])
    store.load_bronze({"erp_loc_a101": first})

    def broken():
        raise RuntimeError("no such source")

    with pytest.raises(RuntimeError):
        store._load("bronze", lambda _: [
            {"erp_loc_a101": lambda: first.limit(0)}, {"erp_px_cat_g1v2": broken},
        ])
    assert store.bronze("erp_loc_a101").count() == 1
    assert len(store.files.names(f"{store.root}/bronze/erp_loc_a101")) == 1
    assert "no such source" in store.log.read().filter("table_name = '(all)' and status = 'failed'").first().message


def test_tables_that_were_not_loaded(job):
    with pytest.raises(LookupError):
        Warehouse(job).bronze("erp_loc_a101")


def test_nothing_staged_is_left_after_a_load(spark, job):
    store = Warehouse(job)
    details = spark.createDataFrame([("NASAW1", None, "F")], BRONZE["erp_cust_az12"])
    store._load("bronze", lambda work: [
        {"erp_cust_az12": lambda: work.stage(details, "aside")},
    ])
    assert store.bronze("erp_cust_az12").count() == 1
    assert store.files.names(job.folder) == ["warehouse"]
