import base64
import hashlib
import hmac
import zlib

import pytest
from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from millrace.functions import checks, text, tokens
from millrace.sources import files, tables
from millrace.session import scratch

SECRET = "0123456789abcdef0123456789abcdef"


def one(spark, col):
    return spark.range(1).select(col).first()[0]


def values(spark, items, col, kind="STRING"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(items)], f"i INT, v {kind}")
    return [r[0] for r in df.select("i", col.alias("x")).orderBy("i").select("x").collect()]


@pytest.mark.parametrize("secret", [SECRET, "s" * 64, "é" * 40, "x" * 200])
def test_token_equals_the_standard_library(spark, secret):
    codes = ["T-1", "", "Ünïcode|.", "a" * 300]
    got = values(spark, codes, tokens.sign_token(F.lit(7).cast("bigint"), F.col("v"), secret))
    for code, token in zip(codes, got, strict=True):
        mac = hmac.new(secret.encode(), f"7|{code}".encode(), hashlib.sha256).digest()
        assert token == f"7|{code}." + base64.urlsafe_b64encode(mac).decode().rstrip("=")


def test_token_checks(spark):
    good = one(spark, tokens.sign_token(F.lit(1), F.lit("A.B"), SECRET))
    other = one(spark, tokens.sign_token(F.lit(1), F.lit("A.B"), SECRET[::-1]))
    assert good != other
    given = [good, other, "2" + good, good[:-1], good.split(".")[0], "", None]
    assert values(spark, given, tokens.verify_token(F.col("v"), SECRET)) == [True] + [False] * 6


@pytest.mark.parametrize("secret", [None, "", "   ", "short", "x" * 31])
def test_weak_secret_is_refused_without_showing_it(secret):
    with pytest.raises(ValueError) as problem:
        tokens.sign_token(F.lit(1), F.lit("A"), secret)
    assert not secret or not secret.strip() or secret not in str(problem.value)


def test_checksum_mismatch(spark):
    content = F.encode(F.lit("abc"), "UTF-8")
    good = hashlib.sha256(b"abc").hexdigest()
    assert one(spark, tokens.verify_checksum(F.lit(good), content)) is None
    assert one(spark, tokens.verify_checksum(F.lit("00"), content)) == (
        f"Checksum mismatch: stored=00 actual={good}"
    )
    assert one(spark, tokens.verify_checksum(F.lit(None).cast("string"), content)).startswith("Checksum")


def test_dates(spark):
    given = ["2026-01-31", " 2026-01-31\t", "2024-02-29", None, "", "  ", "2026-02-29", "2026-01",
             "2026-01-01T10:00", "x", "26-01-01", "2026-1-1"]
    reasons = values(spark, given, checks.check_date(F.col("v")))
    assert [r is None for r in reasons] == [True] * 3 + [False] * 9
    assert reasons[3] == "DATE parameter is required"


def test_longs(spark):
    given = ["1", " 12 ", "+5", "9223372036854775807", None, " ", "0", "-3", "9223372036854775808", "1.0", "a"]
    reasons = values(spark, given, checks.check_positive_long(F.col("v")))
    assert [r is None for r in reasons] == [True] * 4 + [False] * 7
    optional = values(spark, given, checks.check_optional_long(F.col("v")))
    assert [r is None for r in optional] == [True] * 8 + [False] * 3


def test_secret_length_counts_bytes(spark):
    given = ["x" * 32, "x" * 31, "é" * 16, "é" * 15, " " * 40, None]
    reasons = values(spark, given, checks.check_min_bytes(F.col("v")))
    assert [r is None for r in reasons] == [True, False, True, False, False, False]


def test_paths(spark):
    given = ["1.pdf", "bundles/event-1.zip", "a/../b", "a/./b", "../x", "/etc/x", "a/../../x", "a/b/../../..", ".."]
    reasons = values(spark, given, checks.check_path_safe(F.col("v")))
    assert [r is None for r in reasons] == [True] * 4 + [False] * 5


def test_upload_reasons_in_order(spark):
    zip_ = b"PK\x03\x04rest"
    rows = [
        ("a.jar", zip_, "job", "1.0", "org.example.Main", None),
        ("A.JAR", zip_, "job-1_x", "1.0", "a.$B_1", None),
        ("a.zip", b"", "", "", "", "File must have .jar"),
        (None, zip_, "j", "1", "a.B", "File must have .jar extension; received: null"),
        ("a.jar", b"", "j", "1", "a.B", "File is empty"),
        ("a.jar", b"PK", "j", "1", "a.B", "File is not a valid JAR"),
        ("a.jar", b"<htm>", "j", "1", "a.B", "File is not a valid JAR"),
        ("a.jar", zip_, "j", "1", " ", "mainClassName must not be blank"),
        ("a.jar", zip_, "j", "1", "Main", "mainClassName must be"),
        ("a.jar", zip_, "j", "1", "a.B\n", "mainClassName must be"),
        ("a.jar", zip_, "../j", "1", "a.B", "Job name and version must contain"),
        ("a.jar", zip_, "j", "", "a.B", "Job name and version must not be blank"),
        ("a.jar", zip_, "j", "1/2", "a.B", "Job name and version must contain"),
    ]
    df = spark.createDataFrame(rows, "f STRING, c BINARY, j STRING, v STRING, m STRING, want STRING")
    reason = checks.check_upload(*[F.col(c) for c in "fcjvm"])
    for got, want in df.select(reason, "want").collect():
        assert got is None if want is None else got.startswith(want), (got, want)


def test_blank_is_unicode_aware(spark):
    given = ["", " \t\n", " ", " ", "x", None]
    assert values(spark, given, text.is_blank(F.col("v"))) == [True, True, True, False, False, True]


def test_names_and_payload(spark):
    df = spark.createDataFrame(
        [("Ada", "Lovelace", "ada@example.com", "Engineer"), ("Alan", None, "a@x", "M")],
        "first_name STRING, last_name STRING, email STRING, profession STRING",
    )
    upper = text.upper_names(df).collect()
    assert [(r[0], r[1]) for r in upper] == [("ADA", "LOVELACE"), ("ALAN", None)]
    assert text.full_name(df).first()["full_name"] == "Ada Lovelace"
    body = df.select(text.to_payload_json(F.struct("first_name", "last_name")).alias("j")).collect()
    assert body[1]["j"] == '{"first_name":"Alan","last_name":null}'
    nothing = F.lit(None).cast("struct<a:int>")
    assert one(spark, text.to_payload_json(nothing)) == "{}"
    assert str(one(spark, text.parse_value_json(F.lit('{"value":1.99}')))) == "1.99"


def test_messages(spark):
    given = ["x" * 3000, "short", None]
    out = values(spark, given, text.truncate_message(F.col("v")))
    assert [None if v is None else len(v) for v in out] == [2048, 5, None]


def test_root_cause(spark):
    known = ["Poison"]
    rows = [("Poison", "a", "Other", "b"), ("Wrapper", "a", "Poison", "b"), ("Lonely", "a", None, None)]
    df = spark.createDataFrame(rows, "oc STRING, om STRING, ic STRING, im STRING")
    cause = text.root_cause(*[F.col(c) for c in df.columns], known)
    assert [tuple(r[0]) for r in df.select(cause).collect()] == [("Poison", "a"), ("Poison", "b"), ("Lonely", "a")]


def test_uuid_is_stable_and_shaped(spark):
    a, b = (one(spark, text.key_uuid(F.lit("d"), F.lit(str(i)))) for i in (1, 2))
    assert a != b and a == one(spark, text.key_uuid(F.lit("d"), F.lit("1")))
    assert len(a) == 36 and a[14] == "4" and a[19] == "a"


def test_iso_time(spark):
    given = ["2024-01-01 10:20:00", "2024-01-01 10:20:05", "2024-01-01 10:20:00.5", "2024-01-01 10:20:00.000001"]
    out = values(spark, given, text.iso_local_time(F.col("v").cast("timestamp_ntz")))
    assert [v[11:] for v in out] == ["10:20", "10:20:05", "10:20:00.500", "10:20:00.000001"]


def test_entry_names_keep_equal_files_apart(spark):
    names = values(spark, ["/a/t.pdf", "/b/t.pdf"], text.entry_name(F.col("i") * 100, F.col("v")))
    assert names == ["0-t.pdf", "100-t.pdf"]


def test_fields_drop_trailing_empty_ones(spark):
    given = ["a,b,,", "a,,c", "", ",,", "a"]
    assert values(spark, given, files.fields(F.col("v"))) == [["a", "b"], ["a", "", "c"], [""], [], ["a"]]


def write_lines(folder, name, lines):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("".join(line + "\n" for line in lines))


def test_payment_files(spark, tmp_path):
    from millrace.plans.payments import payment_summary

    header = "transaction_id,account_id,amount,currency,status"
    amounts = ["150.75", "320.00", "45.50", "890.25", "67.80"]
    lines = [f"TXN-00{i},ACC-1,{a},USD,COMPLETED" for i, a in enumerate(amounts)]
    write_lines(tmp_path / "one", "a.csv", [header, *lines])
    row = payment_summary(spark, str(tmp_path / "one")).first()
    assert (row["payment_rows"], float(row["payment_total"])) == (5, 1474.30)
    write_lines(tmp_path / "two", "a.csv", [header, *lines, "TXN,ACC", "", "TXN,ACC,,"])
    write_lines(tmp_path / "two", "b.csv", [header, "t,a, 1.5 ,USD"])
    row = payment_summary(spark, str(tmp_path / "two")).first()
    assert (row["payment_rows"], float(row["payment_total"])) == (9, 1475.80)
    write_lines(tmp_path / "bad", "a.csv", [header, "t,a,ten,USD"])
    with pytest.raises(PySparkException, match="not a number"):
        payment_summary(spark, str(tmp_path / "bad")).collect()


def test_header_is_dropped_once_when_a_file_is_split(spark, tmp_path):
    write_lines(tmp_path / "in", "a.csv", ["h,h,h", *[f"k{i},a,{i}.5,x" for i in range(2000)]])
    write_lines(tmp_path / "in", "b.csv", ["h,h,h"])
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2000")
    try:
        lines = files.scan_lines(spark, str(tmp_path / "in"))
        assert lines.rdd.getNumPartitions() > 5
        assert lines.count() == 2000
        total = files.scan_lenient_lines(lines).agg(F.sum("amount")).first()[0]
        assert float(total) == sum(i + 0.5 for i in range(2000))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


@pytest.mark.parametrize("block", ["40", "100000"])
def test_only_the_first_line_of_a_file_goes(spark, tmp_path, block):
    write_lines(tmp_path / "in", "a.csv", ["h,h,h", "k,a,1,x", "h,h,2", "k,a,3,x", *["h,h,4"] * 30])
    write_lines(tmp_path / "in", "b.csv", ["other header", "k,a,0.0000004,x", "other header"])
    (tmp_path / "in" / "empty.csv").write_text("")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", block)
    try:
        lines = files.scan_lines(spark, str(tmp_path / "in"))
        got = sorted(r["value"] for r in lines.collect())
        assert got == sorted(["k,a,1,x", "h,h,2", "k,a,3,x", *["h,h,4"] * 30, "k,a,0.0000004,x", "other header"])
        total = files.scan_lenient_lines(lines).agg(F.sum("amount")).first()[0]
        assert str(total).rstrip("0") == "126.0000004"
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_amounts_lose_no_digit(spark):
    read = lambda v: files.scan_lenient_lines(spark.createDataFrame([(f"a,b,{v}",)], "value STRING")).first()["amount"]
    assert str(read("0.000000000000000001")) == "1E-18" and float(read("1.50" + "0" * 30)) == 1.5 and float(read("2.5E3")) == 2500
    for lost in ("0.0000000000000000001", "1E-19"):
        with pytest.raises(PySparkException, match="too many decimals"):
            read(lost)


def test_separators_are_plain_text(spark):
    assert values(spark, ["a|b||", "|", "a.b"], files.fields(F.col("v"), "|")) == [["a", "b"], [], ["a.b"]]


def test_files_and_missing_ones(spark, tmp_path):
    (tmp_path / "x.pdf").write_bytes(b"abc")
    found = files.scan_files(spark, str(tmp_path), "*.pdf")
    row = found.first()
    assert (row["size_bytes"], row["checksum_sha256"]) == (3, hashlib.sha256(b"abc").hexdigest())
    expected = spark.createDataFrame([(row["path"],), ("file:/gone.pdf",)], "path STRING")
    assert [r[0] for r in files.missing_files(expected, found).collect()] == ["file:/gone.pdf"]
    with pytest.raises(PySparkException, match="missing file"):
        files.require_files(expected, found).collect()


def listed_by_reader(spark, path, glob="*"):
    read = spark.read.format("binaryFile").option("pathGlobFilter", glob).option("recursiveFileLookup", True).load(str(path))
    return read.select("path", F.octet_length("content").cast("bigint"), F.sha2("content", 256))


def test_files_are_listed_in_tasks_as_by_the_reader(spark, tmp_path):
    """The driver holds no list of the files; the same files count as for Spark's reader, which does."""
    names = "a.txt _h.txt .h.txt _h=1.txt _metadata x._COPYING_ b.bin empty.txt sub/b.txt _sub/c.txt .sub/c.txt _sub=1/d.txt"
    more = "k=1/j=2/f.txt k=1/g.txt sub/_temporary/0/t.txt _metadata_dir/q.txt"
    for name in [*names.split(), *more.split(), "s p%20ä+#?.txt", "n\nl.txt"]:
        file = tmp_path / "all" / name
        file.parent.mkdir(parents=True, exist_ok=True)
        file.write_bytes(b"" if name == "empty.txt" else name.encode())
    (tmp_path / "all/link.txt").symlink_to(tmp_path / "all/a.txt")
    (tmp_path / "all/folder").symlink_to(tmp_path / "all/sub")
    (tmp_path / "all/dangling.txt").symlink_to(tmp_path / "nowhere")
    (tmp_path / "none").mkdir()
    for path, glob in [("all", "*"), ("all", "*.txt"), ("all", "{a,b}.*"), ("all", "[!a].txt"), ("all", "?.bin"), ("none", "*"),
                       ("all/a.txt", "*"), ("all/_h.txt", "*"), ("all/_sub", "*"), ("all/../all/k=1/", "*")]:
        found = files.scan_files(spark, f"{tmp_path}/{path}", glob)
        want = listed_by_reader(spark, f"{tmp_path}/{path}", glob)
        assert found.inputFiles() == [] and found.dtypes == files.scan_files(spark, f"{tmp_path}/{path}*", glob).dtypes
        assert sorted(map(tuple, found.collect())) == sorted(map(tuple, want.collect())), (path, glob)
    assert files.scan_files(spark, f"{tmp_path}/all/a*").count() == 1
    with pytest.raises(PySparkException, match="PATH_NOT_FOUND"):
        files.scan_files(spark, f"{tmp_path}/gone")


def test_many_files_of_few_folders_are_not_broadcast(spark, tmp_path):
    """A join knows the size of all files, not only that of the folders they lie in."""
    for i in range(3000):
        file = tmp_path / f"folder={i % 2}" / f"{i}.txt"
        file.parent.mkdir(exist_ok=True)
        file.write_text("x")
    keep = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "20k")
    try:
        found = files.scan_files(spark, str(tmp_path)).select("path")
        expected = spark.range(3000).select(F.format_string(f"file:{tmp_path}/folder=%d/%d.txt", F.col("id") % 2, "id").alias("path"))
        joined = files.require_files(expected.repartition(4), found)
        assert len(joined.collect()) == 3000
        assert "Broadcast" not in joined._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", keep)


def test_a_file_that_differs_from_its_checksums_fails(spark, tmp_path):
    """Checksum files of Hadoop's local writer hold, those that are none do not count."""
    file, data = tmp_path / "a.txt", bytes(range(256)) * 10
    sums = b"".join(zlib.crc32(data[i : i + 512]).to_bytes(4, "big") for i in range(0, len(data), 512))
    file.write_bytes(data)
    (tmp_path / ".a.txt.crc").write_bytes(b"crc\0" + (512).to_bytes(4, "big") + sums)
    assert files.scan_files(spark, str(tmp_path)).first()["size_bytes"] == 2560
    for changed in (data[:-1] + b"x", data + b"x", data[:-1]):
        file.write_bytes(changed)
        with pytest.raises(Py4JJavaError, match="FAILED_READ_FILE"):
            listed_by_reader(spark, tmp_path).collect()
        with pytest.raises(PySparkException, match="checksum error"):
            files.scan_files(spark, str(tmp_path)).collect()
    (tmp_path / ".a.txt.crc").write_bytes(b"none")
    assert files.scan_files(spark, str(tmp_path)).first()["size_bytes"] == 2559


def test_database_ranges():
    assert tables.range_predicates("id", [(1, 5), (6, 9)]) == ["id BETWEEN 1 AND 5", "id BETWEEN 6 AND 9"]


def test_pages_follow_each_other(spark):
    df = spark.createDataFrame([(i, i % 4 == 0) for i in range(20)], "id BIGINT, processed BOOLEAN")
    after, seen = -1, []
    while page := [r["id"] for r in tables.scan_keyset(df, "id", after, 4).collect()]:
        seen += page
        after = page[-1]
    assert seen == [i for i in range(20) if i % 4]


def test_constraints(spark):
    parent = spark.createDataFrame([(1,), (2,)], "id BIGINT")
    rows = [(1, "ab", 0, 1), (1, None, -1, 2), (2, "abcd", 5, 9), (None, "a", 5, None)]
    df = spark.createDataFrame(rows, "k BIGINT, name STRING, n INT, fk BIGINT")
    out = checks.check_constraints(
        df,
        [
            checks.NotNull("name"),
            checks.MaxLength("name", 3),
            checks.AtLeast("n", 0),
            checks.Unique("k"),
            checks.ForeignKey("fk", parent, "id"),
        ],
    )
    assert {r["rule"]: r["violations"] for r in out.collect()} == {
        "not_null(name)": 1,
        "max_length(name)": 1,
        "at_least(n)": 1,
        "unique(k)": 1,
        "foreign_key(fk)": 1,
    }


def test_malformed_csv_fails(spark):
    path = scratch(spark, "bad.csv")
    spark.createDataFrame([("a,b,c,d,e",)], "value STRING").write.text(path)
    with pytest.raises(Exception, match="MALFORMED_CSV_RECORD"):
        files.scan_delimited(spark, path, ["a", "b", "c", "d"]).collect()
