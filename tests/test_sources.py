import hashlib
from datetime import datetime

import pytest
from conftest import rows_by
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

from parcelwise.quality import gate
from parcelwise.sources import files, layout, scratch, sinks

SCHEMA = "id bigint, message string"
HEADER = ",".join(layout.columns_of("order_reviews")) + "\n"


def write(path, text, encoding="utf-8"):
    path.write_text(text, encoding=encoding, newline="")
    return str(path)


def scan(spark, path, multiline=False):
    from pyspark.sql.types import StructType
    return files.scan_csv(spark, path, StructType.fromDDL(SCHEMA), multiline)


def test_records_not_lines(spark, tmp_path):
    p = write(tmp_path / "a.csv", 'id,message\n1,"one\ntwo\nthree"\n2,"x"\n')
    assert scan(spark, p, multiline=True).count() == 2


@pytest.mark.parametrize("body, n", [("1,a\n2,b\n", 2), ('1,"a, b, c"\n2,"d, e"\n', 2),
                                     ('1,"say ""hi"" now"\n', 1), ("", 0)])
def test_quoting_and_empty_files(spark, tmp_path, body, n):
    p = write(tmp_path / "a.csv", "id,message\n" + body)
    assert scan(spark, p).count() == n
    if "hi" in body:
        assert scan(spark, p).first().message == 'say "hi" now'


def test_byte_order_mark_is_dropped(spark, tmp_path):
    p = write(tmp_path / "a.csv", "id,message\n1,café\n", "utf-8-sig")
    assert tuple(scan(spark, p).first()) == (1, "café")
    assert files.header_of(spark, p) == ["id", "message"]


@pytest.mark.parametrize("text", ["id,message\nbad,x\n", "id,text\n1,x\n", "message,id\nx,1\n"])
def test_bad_file_is_rejected_whole(spark, tmp_path, text):
    with pytest.raises(Exception, match="(?i)malformed|header|FAILED_READ"):
        scan(spark, write(tmp_path / "a.csv", text)).collect()


def test_header_must_match_the_declaration(spark, tmp_path):
    good = write(tmp_path / "s.csv", ",".join(layout.columns_of("sellers")) + "\n")
    swapped = write(tmp_path / "t.csv", ",".join(reversed(layout.columns_of("sellers"))) + "\n")
    assert files.header_matches(spark, good, "sellers")
    assert not files.header_matches(spark, swapped, "sellers")


def test_layout_is_consistent():
    assert set(layout.TABLES) == set(layout.EXPECTED_ROWS) == set(layout.KEYS)
    assert sum(layout.EXPECTED_ROWS.values()) == 1_550_922
    for t in layout.TABLES:
        fields = layout.schema_of(t).fields
        assert all(f.nullable for f in fields)
        assert len({f.name for f in fields}) == len(fields)
        assert set(layout.KEYS[t]) <= {f.name for f in fields}
    for t, c in (("order_items", "price"), ("order_items", "freight_value"),
                 ("order_payments", "payment_value")):
        assert isinstance(layout.schema_of(t)[c].dataType, DecimalType)


def test_table_choice():
    assert layout.choose_tables(["sellers", "orders"]) == ["orders", "sellers"]
    assert layout.choose_tables() == list(layout.TABLES)
    with pytest.raises(ValueError, match="nope"):
        layout.choose_tables(["orders", "nope"])


@pytest.fixture
def batch(tmp_path):
    sellers = ",".join(layout.columns_of("sellers")) + "\ns1,100,x,SP\ns2,200,y,RJ\n"
    reviews = HEADER + 'r1,o1,5,t,"a\nb",2018-01-01 00:00:00,2018-01-02 00:00:00\n'
    return {"sellers": write(tmp_path / "sellers.csv", sellers),
            "order_reviews": write(tmp_path / "reviews.csv", reviews)}


def test_manifest_stamp_and_reconciliation(spark, batch):
    m = files.manifest(spark, batch, {"sellers": 2, "order_reviews": 9}, byte_checksum=True)
    rows = rows_by(m, "table")
    with open(batch["sellers"], "rb") as fh:
        body = fh.read()
    assert rows["sellers"].sha256 == hashlib.sha256(body).hexdigest()
    assert rows["sellers"].bytes == len(body)
    assert rows["sellers"].rows_match_expected and not rows["order_reviews"].rows_match_expected
    assert rows["order_reviews"].rows == 1

    loaded = {t: files.stamp(files.scan_table(spark, p, t), "b1", datetime(2020, 1, 1),
                             rows[t].content_digest) for t, p in batch.items()}
    one = loaded["sellers"].first()
    assert one._source_digest == rows["sellers"].content_digest is not None
    assert one._batch_id == "b1" and one._source_uri.endswith("sellers.csv")
    assert {r.status for r in files.reconcile(m, loaded).collect()} == {"OK"}
    loaded["sellers"] = loaded["sellers"].limit(1)
    bad = rows_by(files.reconcile(m, loaded), "table")["sellers"]
    assert (bad.delta, bad.status) == (-1, "MISMATCH")


def test_fingerprint_ignores_order_and_sees_duplicates(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b"), (2, "b")], SCHEMA)
    same = files.fingerprint(df.orderBy(F.desc("id"))).first()
    assert same == files.fingerprint(df).first()
    assert files.fingerprint(df.distinct()).first() != same


def test_checksum_covers_the_whole_file(spark, tmp_path):
    head = ",".join(layout.columns_of("sellers")) + "\n" + "s1,100,x,SP\n" * (1 << 17)
    paths = [write(tmp_path / f"{x}.csv", head + f"s2,1,{x},RJ\n") for x in "ab"]
    digests = {files.manifest(spark, {"sellers": p}, {}, True).first()[c] for p in paths
               for c in ("sha256", "content_digest")}
    assert len(digests) == 4


def test_file_gate(spark, batch, tmp_path):
    ok = gate.report(gate.file_results(spark, {"sellers": batch["sellers"]}, {"sellers": 2}))
    assert not ok.blocked and ok.summary() == "1/1 tables passed"
    long_state = write(tmp_path / "bad.csv", ",".join(layout.columns_of("sellers"))
                       + "\n,100,x,SPX\n")
    red = gate.report(gate.file_results(spark, {"sellers": long_state}, {"sellers": 2}))
    assert {r["rule"] for r in red.failures} == {
        "row_count(*)", "not_null(seller_id)", "length(seller_state)"}
    header = write(tmp_path / "h.csv", "a,b\n1,2\n")
    red = gate.report(gate.file_results(spark, {"sellers": header}, {"sellers": 1}))
    assert [r["rule"] for r in red.failures] == ["columns(declared, in order)"]


def test_folder_comparison(spark, tmp_path):
    src, dst = tmp_path / "src", tmp_path / "dst"
    src.mkdir(), dst.mkdir()
    for name, a, b in (("same", "x" * 100, "x" * 100), ("bom", "x" * 100, "x" * 97),
                       ("cut", "x" * 100, "x" * 50), ("gone", "x", None), ("new", None, "x")):
        if a is not None:
            write(src / f"{name}.csv", a)
        if b is not None:
            write(dst / f"{name}.csv", b)
    got = {r.file: r.status for r in files.compare_folders(spark, str(src), str(dst)).collect()}
    assert got == {"same.csv": "ok", "bom.csv": "ok", "cut.csv": "size mismatch",
                   "gone.csv": "missing in target", "new.csv": "not in source"}


class Session:
    """Stands in for a session, to vary what cannot be changed on a live one."""

    def __init__(self, master, folder=None):
        self.conf = {scratch.CHECKPOINT_KEY: folder} if folder else {}
        self.sparkContext = type("Context", (), {"master": master, "applicationId": master})


def test_scratch_uses_the_folder_the_cluster_names():
    assert scratch.scratch_root(Session("yarn", "hdfs://shared/x/")) == "hdfs://shared/x"
    with pytest.raises(RuntimeError, match="every executor"):
        scratch.scratch_root(Session("yarn"))
    local = scratch.scratch_root(Session("local[2]"))
    assert local == scratch.scratch_root(Session("local[2]"))


def test_scratch_saves_what_it_is_given(spark):
    s = scratch.Scratch(spark)
    kept = s.save(spark.range(3).toDF("k"), "t")
    assert sorted(r.k for r in kept.collect()) == [0, 1, 2]
    assert s.root in kept.inputFiles()[0]


def test_nothing_released_yet(spark, tmp_path):
    assert sinks.released(spark, str(tmp_path / "none")) is None
    with pytest.raises(LookupError):
        sinks.read_released(spark, str(tmp_path / "none"), "fct_orders")


def test_manifest_of_colliding_and_multi_file_folders(spark, tmp_path):
    head = ",".join(layout.columns_of("sellers")) + "\n"
    for k in (1, 2):
        (tmp_path / "sellers" / "orders").mkdir(parents=True, exist_ok=True)
        (tmp_path / "sellers" / "sellers").mkdir(parents=True, exist_ok=True)
        write(tmp_path / "sellers" / "sellers" / f"{k}.csv", head + f"s{k},100,x,SP\n")
    orders = ",".join(layout.columns_of("orders")) + "\n"
    write(tmp_path / "sellers" / "orders" / "o.csv", orders)
    got = rows_by(files.manifest(spark, {
        "sellers": str(tmp_path / "sellers" / "sellers"),
        "orders": str(tmp_path / "sellers" / "orders")}, {}, True), "table")
    assert got["sellers"].rows == 2 and got["orders"].rows == 0
    assert got["orders"].bytes == len(orders.encode())
    assert got["sellers"].sha256 and got["sellers"].content_digest


def test_a_later_release_of_one_table_leaves_the_others(spark, tmp_path):
    from parcelwise.sources import sinks
    root = str(tmp_path / "raw")
    for release, tables in (("1", "ab"), ("2", "b")):
        for t in tables:
            spark.createDataFrame([(release,)], "x string").write.parquet(f"{root}/{release}/{t}")
        sinks.mark_released(spark, root, release, sinks.released(spark, root))
    assert sinks.read_released(spark, root, "a").first().x == "1"
    assert sinks.read_released(spark, root, "b").first().x == "2"
