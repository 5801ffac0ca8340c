"""File scans on small folders: shapes, edge cases, broken files."""

import gzip
import os
import zipfile
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from millrace.sources import files as files_module
from millrace.sources import opened
from millrace.sources.files import file_inventory, read_files, wider


def put(folder, name, text):
    path = os.path.join(folder, name)
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "wb" if isinstance(text, bytes) else "w") as f:
        f.write(text)
    return path


def rows(df, *columns):
    return sorted((tuple(r) for r in (df.select(*columns) if columns else df).collect()), key=repr)


def test_delimited_defaults(spark, folder):
    put(folder, "a.csv", 'k,n,t,f\n1,2,"x,y",true\n2,N/A,z,false\n3,4.5,,true\n')
    df = read_files(spark, folder, "*.csv")
    assert [f.dataType.simpleString() for f in df.schema.fields] == ["bigint", "double", "string", "boolean"]
    assert rows(df) == [(1, 2.0, "x,y", True), (2, None, "z", False), (3, 4.5, None, True)]


def test_short_rows_are_padded_and_long_rows_fail(spark, folder):
    put(folder, "a.csv", "a,b,c\n1,2\n")
    put(folder, "b.csv", "a,b,c\n5,6,7\n")
    assert rows(read_files(spark, folder)) == [(1, 2, None), (5, 6, 7)]
    put(folder, "c.csv", "a,b,c\n7,8,9\n7,8,9,10\n")
    with pytest.raises(Exception, match="cannot parse"):
        read_files(spark, folder).collect()
    assert rows(read_files(spark, folder, skip_errors=True)) == [(1, 2, None), (5, 6, 7)]


def test_trailing_separator_makes_a_row_too_long(spark, folder):
    put(folder, "a.csv", "a,b\n1,2\n3,4,\n")
    put(folder, "b.csv", "a,b\n5,6\n")
    assert rows(read_files(spark, folder, skip_errors=True)) == [(5, 6)]


def test_wrong_declared_type_drops_the_file(spark, folder):
    put(folder, "a.csv", "a,b\n1,2\nx,3\n")
    put(folder, "b.csv", "a,b\n5,6\n")
    opts = {"dtype": {"a": "int", "b": "str"}}
    assert rows(read_files(spark, folder, options=opts, skip_errors=True)) == [(5, "6")]
    with pytest.raises(Exception, match="cannot parse"):
        read_files(spark, folder, options=opts).collect()


def test_headers_in_different_order(spark, folder):
    put(folder, "a.csv", "a,b\n1,x\n")
    put(folder, "b.csv", 'c,"b",a\n2,y,3\n')
    assert rows(read_files(spark, folder), "a", "b", "c") == [(1, "x", None), (3, "y", 2)]


def test_separator_per_extension_in_one_folder(spark, folder):
    put(folder, "a.csv", "a,b\n1,x\n")
    put(folder, "b.tsv", "a\tb\n2\ty,z\n")
    put(folder, "c.txt", "a,d\n3,w\n")
    assert rows(read_files(spark, folder), "a", "b", "d") == [(1, "x", None), (2, "y,z", None), (3, None, "w")]


def test_options(spark, folder):
    put(folder, "a.csv", "id;when;keep\n007;02/01/2024;-\n")
    df = read_files(
        spark, folder,
        options={
            "delimiter": ";", "dtype": {"id": "str"}, "parse_dates": ["when"], "date_formats": ["%d/%m/%Y"],
            "na_values": ["-"], "usecols": ["id", "when"],
        },
    )
    assert rows(df) == [("007", datetime(2024, 1, 2))]
    with pytest.raises(ValueError, match="unknown"):
        read_files(spark, folder, options={"delimitr": ";"})


def test_header_titles(spark, folder):
    put(folder, "a.csv", '\ufeff"a,x",b,b,"say ""c"""\n1,2,3,4\n')
    assert read_files(spark, folder).columns == ["a,x", "b", "b.1", 'say "c"']
    assert [tuple(r) for r in read_files(spark, folder).collect()] == [(1, 2, 3, 4)]
    put(folder, "b.csv", "b\n9\n")
    with pytest.raises(ValueError, match="repeats"):
        read_files(spark, folder)
    with pytest.raises(ValueError, match="first row"):
        read_files(spark, folder, options={"header": 2})
    named = read_files(spark, folder, "b.csv", options={"names": ["n"]})
    assert rows(named) == [("9",), ("b",)]
    assert rows(read_files(spark, folder, "b.csv", options={"names": ["n"], "header": 0})) == [(9,)]


def test_one_header_promised(spark, folder):
    put(folder, "a.csv", "a,b\n1,x\n")
    put(folder, "b.csv", "a,b\n2,y\n3\n")
    opts = {"same_header": True, "dtype": {"a": "int", "b": "str"}}
    assert rows(read_files(spark, folder, options=opts)) == [(1, "x"), (2, "y"), (3, None)]
    put(folder, "c.csv", "b,a\ny,2\n")
    with pytest.raises(Exception, match="(?i)header"):
        read_files(spark, folder, options=opts).collect()


def test_no_header_and_other_encoding(spark, folder):
    put(folder, "a.csv", "å,1\nö,2\n".encode("latin-1"))
    df = read_files(spark, folder, options={"header": None, "names": ["t", "n"]}, encoding="latin-1")
    assert rows(df) == [("å", 1), ("ö", 2)]


def test_lineage(spark, folder):
    put(folder, "a.csv", "a\n1\n")
    when = datetime(2024, 5, 6, 7, 8, 9)
    assert rows(read_files(spark, folder, lineage_time=when)) == [(1, "a.csv", folder, when)]


def test_no_files_and_unknown_types(spark, folder):
    assert read_files(spark, folder).columns == []
    assert read_files(spark, folder + "/nope").columns == []
    assert read_files(spark, folder, "*.csv", file_type="csv").columns == []
    put(folder, "a.bin", "x")
    with pytest.raises(ValueError, match="unsupported"):
        read_files(spark, folder)
    with pytest.raises(ValueError, match="unsupported"):
        read_files(spark, folder, file_type="bin")


def test_single_file_and_pattern(spark, folder):
    one = put(folder, "sales_1.csv", "a\n1\n")
    put(folder, "sales_2.csv", "a\n2\n")
    put(folder, "other.csv", "a\n3\n")
    assert rows(read_files(spark, one)) == [(1,)]
    assert rows(read_files(spark, folder, "sales_*")) == [(1,), (2,)]
    assert rows(read_files(spark, folder + "/sales_*.csv")) == [(1,), (2,)]


@pytest.mark.parametrize(
    "text, want",
    [
        ('[{"a": 1, "b": "x"}, {"a": 2.5}]', [(1.0, "x"), (2.5, None)]),
        ('{"meta": {"n": 2}, "z": [1], "items": [{"a": 1}], "more": [{"b": 2}]}', [(1,)]),
        ('{"a": {"b": 1}, "s": "[{\\"c\\": 1}]"}', [((1,), '[{"c": 1}]')]),
        ("[1, 2.5, \"x\"]", [("1",), ("2.5",), ("x",)]),
        ('"word"', [("word",)]),
        ("42", [("42",)]),
        ("[]", []),
        ('{"a": 1, "rows": [{"k": 1}], "rows": [{"k": 2, "k": 3}, {"k": 4}]}', [(3,), (4,)]),
        ('{"a": 1, "b": 2, "a": [{"z": 5}]}', [(5,)]),
        ('{"b": [{"y": 1}], "a": [{"z": 5}], "b": 7}', [(5,)]),
        ('[{"it\'s": 1, "a b": 2, "c.d": [1.5], "e": null}]', [(2, [1.5], None, 1)]),
        ('[null, [1, {"a": 2}], {"b": "x"}, true]', [(None,), ('[1,{"a":2}]',), ('{"b":"x"}',), ("true",)]),
    ],
)
def test_json_documents(spark, folder, text, want):
    put(folder, "a.json", text)
    assert rows(read_files(spark, folder)) == sorted(want, key=repr)


def test_json_documents_are_parsed_once(spark, folder):
    put(folder, "a.json", '{"x": 1, "rows": [{"a": 1}]}')
    plans = []
    real = files_module.settle

    def settled(df, label):
        plans.append((label, df._jdf.queryExecution().optimizedPlan().numberedTreeString()))
        return real(df, label)

    files_module.settle = settled
    try:
        got = read_files(spark, folder)
    finally:
        files_module.settle = real
    (items,) = [p for label, p in plans if label == "items"]
    assert items.count("from_json") == 1 and items.lower().replace("_", "").count("parsejson(") == 1
    later = got._jdf.queryExecution().optimizedPlan().toString().lower()
    assert "from_json" not in later and "parse_json" not in later and rows(got) == [(1,)]
    assert spark.conf.get("spark.sql.variant.allowDuplicateKeys") == "false"


def test_json_mixed_and_broken_documents(spark, folder):
    put(folder, "a.json", '[{"a": 1}]')
    put(folder, "b.json", '{"a": 2, "c": null}')
    put(folder, "c.json", '[{"a": 3}')
    assert rows(read_files(spark, folder, skip_errors=True), "a") == [(1,), (2,)]
    with pytest.raises(Exception, match="cannot parse"):
        read_files(spark, folder).collect()
    assert rows(read_files(spark, folder, options={"schema": "a string"}, skip_errors=True)) == [("1",), ("2",)]


def test_json_lines(spark, folder):
    put(folder, "a.json", '{"a": 1}\n{"a": 2, "b": "x"}\n')
    opts = {"lines": True}
    assert rows(read_files(spark, folder, options=opts), "a", "b") == [(1, None), (2, "x")]
    put(folder, "b.json", '{"a": 9}\n{"a": \n')
    assert rows(read_files(spark, folder, options=opts, skip_errors=True), "a", "b") == [(1, None), (2, "x")]
    with pytest.raises(Exception):
        read_files(spark, folder, options={**opts, "schema": "a int, b string"}).collect()


def test_xml(spark, folder):
    put(
        folder, "a.xml",
        '<root><item id="1"><n>A</n><m u="3">7</m><r>1</r><r>2</r></item><item id="2"><n>B</n></item></root>',
    )
    want = [("1", "7", "A", "2"), ("2", None, "B", None)]
    assert rows(read_files(spark, folder), "item_id", "m", "n", "r") == want
    opts = {"xpath": "./item"}
    assert rows(read_files(spark, folder, options=opts), "item_id", "m", "n", "r") == want
    put(folder, "b.xml", '<root><item id="3"><n>C</n></item>')
    assert rows(read_files(spark, folder, options=opts, skip_errors=True), "item_id", "m", "n", "r") == want


def test_comment_lines_before_the_header(spark, folder):
    put(folder, "a.csv", "# made by hand\nk,v\n1,a\n# more\n2,b\n")
    put(folder, "b.csv", "# other\nv,k\nc,3\n")
    got = read_files(spark, folder, options={"comment": "#"})
    assert rows(got, "k", "v") == [(1, "a"), (2, "b"), (3, "c")]


def test_unknown_extensions_are_passed_over_on_request(spark, folder):
    put(folder, "a.csv", "k\n1\n")
    put(folder, "b.doc", "nothing to read")
    with pytest.raises(ValueError):
        read_files(spark, folder)
    assert rows(read_files(spark, folder, skip_errors=True), "k") == [(1,)]


def test_xml_paths(spark, folder):
    put(
        folder, "a.xml",
        '<root><a><item><n>1</n></item></a><b><item><n>2</n></item><x><a><item><n>3</n></item></a></x></b><n>top</n></root>',
    )
    read = lambda p: rows(read_files(spark, folder, options={"xpath": p}), "n")
    assert read("./a/item") == [("1",)] == read("/root/a/item")
    assert read("//item") == [("1",), ("2",), ("3",)] and read("//a/item") == [("1",), ("3",)]
    assert read("/root/*/item") == [("1",), ("2",)]
    for bad in ("./a[1]", "a::b", "./a/@n"):
        with pytest.raises(ValueError):
            read(bad)


def test_columnar_with_missing_columns_and_broken_file(spark, folder):
    spark.range(2).write.parquet(f"{folder}/x/a")
    spark.range(5, 7).selectExpr("id", "id * 2 AS twice").write.parquet(f"{folder}/x/b")
    assert rows(read_files(spark, f"{folder}/x/*"), "id", "twice") == [(0, None), (1, None), (5, 10), (6, 12)]
    put(f"{folder}/x/a", "broken.parquet", "not a parquet file")
    df = read_files(spark, f"{folder}/x/*", options={"schema": "id bigint"}, skip_errors=True)
    assert rows(df) == [(0,), (1,), (5,), (6,)]


def test_avro(spark, folder):
    """The avro source is a package of its own; without it Spark says so."""
    try:
        spark.range(2).write.format("avro").save(f"{folder}/x")
    except AnalysisException:
        put(folder, "a.avro", "x")
        with pytest.raises(AnalysisException, match="(?i)avro"):
            read_files(spark, folder)
        return
    assert rows(read_files(spark, f"{folder}/x")) == [(0,), (1,)]


def test_inventory_and_modified_after(spark, folder):
    old, new = put(folder, "old.csv", "a\n1\n"), put(folder, "new.csv", "a\n22\n")
    at = datetime(2024, 1, 1, 12, 0, 0)
    for path, when in ((old, at), (new, at + timedelta(seconds=1))):
        stamp = when.replace(tzinfo=timezone.utc).timestamp()
        os.utime(path, (stamp, stamp))
    listed = rows(file_inventory(spark, folder))
    assert listed == [("new.csv", folder, 5, at + timedelta(seconds=1)), ("old.csv", folder, 4, at)]
    assert rows(read_files(spark, folder, file_type="csv", modified_after=at)) == [(22,)]
    assert read_files(spark, folder, file_type="csv", modified_after=at + timedelta(days=1)).columns == []
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
    try:
        assert rows(file_inventory(spark, folder)) == listed
        assert rows(read_files(spark, folder, file_type="csv", modified_after=at)) == [(22,)]
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


# --- workbooks ------------------------------------------------------------------------------

_NS = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'


def workbook(path, sheets, shared=()):
    """A minimal .xlsx: sheets are name → list of rows of (type, value) cells or None."""
    rel = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"

    def cell(col, row, content):
        if content is None:
            return ""
        kind, value = content
        ref = f'r="{chr(65 + col)}{row + 1}"'
        if kind == "inlineStr":
            return f'<c {ref} t="inlineStr"><is><t>{value}</t></is></c>'
        return f'<c {ref}{f" t={chr(34)}{kind}{chr(34)}" if kind else ""}><v>{value}</v></c>'

    with zipfile.ZipFile(path, "w") as z:
        listed = "".join(f'<sheet name="{n}" sheetId="{i}" r:id="rId{i}"/>' for i, n in enumerate(sheets, 1))
        z.writestr("xl/workbook.xml", f'<workbook {_NS} xmlns:r="{rel}"><sheets>{listed}</sheets></workbook>')
        rels = "".join(f'<Relationship Id="rId{i}" Target="worksheets/s{i}.xml"/>' for i in range(1, len(sheets) + 1))
        z.writestr("xl/_rels/workbook.xml.rels", f"<Relationships>{rels}</Relationships>")
        if shared:
            items = "".join(f"<si><t>{t}</t></si>" for t in shared)
            z.writestr("xl/sharedStrings.xml", f"<sst {_NS}>{items}</sst>")
        for i, body in enumerate(sheets.values(), 1):
            lines = "".join(
                f'<row r="{y + 1}">{"".join(cell(x, y, c) for x, c in enumerate(line))}</row>' for y, line in enumerate(body)
            )
            z.writestr(f"xl/worksheets/s{i}.xml", f"<worksheet {_NS}><sheetData>{lines}</sheetData></worksheet>")


def test_workbooks(spark, folder):
    head = [("s", 0), ("s", 1), ("inlineStr", "flag")]
    workbook(
        f"{folder}/a.xlsx",
        {
            "first": [[("inlineStr", "note")], head, [("", "1"), ("s", 2), ("b", "1")], [("", "2.5"), None, ("b", "0")]],
            "second": [[("inlineStr", "x")], [("", "9")]],
        },
        ["n", "word", "hej"],
    )
    opts = {"skiprows": 1}
    df = read_files(spark, folder, "*.xlsx", options=opts)
    assert rows(df) == [(1.0, "hej", True), (2.5, None, False)]
    assert rows(read_files(spark, folder, "*.xlsx", options={"sheet_name": "second"})) == [(9,)]
    put(folder, "b.xlsx", "no zip")
    assert rows(read_files(spark, folder, "*.xlsx", options=opts, skip_errors=True), "n") == [(1.0,), (2.5,)]
    with pytest.raises(Exception, match="cannot parse"):
        read_files(spark, folder, "*.xlsx", options=opts).collect()


# --- facts found by opening files -------------------------------------------------------------------------------


def test_headers_are_read_from_the_first_bytes(spark, folder):
    big = "a;b\n" + "1;2\n" * 500_000
    pre = "\ufeff# note\n\n  \n#more; or less\n"
    put(folder, "a.csv", pre + big)
    put(folder, "b %41.csv", big.replace("\n", "\r\n"))
    put(folder, "c.csv", "#" + "x" * 200_000 + "\nb;c\n3;4\n")
    put(folder, "d.csv", "# only remarks\n")
    put(folder, "e.csv", "b;a")
    with gzip.open(f"{folder}/f.csv.gz", "wt") as file:
        file.write("a;b\n5;6\n")
    files = opened.listed(spark.read, folder)
    assert opened.openable(files) and opened.openable(files.limit(0))
    got = {r["path"].rsplit("/", 1)[1]: (r["line"], r["bytes_read"]) for r in opened.header_lines(files, "utf-8", "#").collect()}
    assert {k: v[0] for k, v in got.items()} == {"a.csv": "a;b", "b%20%2541.csv": "a;b", "c.csv": "b;c", "e.csv": "b;a", "f.csv.gz": "a;b"}
    assert got["a.csv"][1] <= opened.BLOCK_BYTES and got["b%20%2541.csv"][1] <= opened.BLOCK_BYTES and got["c.csv"][1] <= 200_000 + 2 * opened.BLOCK_BYTES
    rows = read_files(spark, folder, "*.csv*", "csv", {"delimiter": ";", "comment": "#"})
    assert sorted(rows.columns) == ["a", "b", "c"] and rows.count() == 1_000_002
    assert rows.filter("c = 4 AND b = 3 AND a IS NULL").count() == 1


def test_header_in_wide_encoding(spark, folder):
    with open(f"{folder}/a.csv", "w", encoding="utf-16") as file:
        file.write("å,b\n1,2\n")
    files = opened.listed(spark.read, folder)
    assert [r["line"] for r in opened.header_lines(files, "utf-16").collect()] == ["å,b"]


def part(spark, folder, name, fmt, **columns):
    spark.range(3).select(*[F.expr(x).alias(c) for c, x in columns.items()]).coalesce(1).write.format(fmt).save(f"{folder}/{name}")


@pytest.mark.parametrize("fmt", ["parquet", "orc"])
def test_columns_of_several_types_are_widened(spark, folder, fmt):
    part(spark, folder, "a", fmt, k="cast(id AS int)", d="cast(id AS decimal(5,2))", t="date'2024-01-01'", s="cast(id AS string)", n="named_struct('x', id)")
    part(spark, folder, "b", fmt, k="id", d="cast(id AS decimal(9,1))", t="timestamp_ntz'2024-01-01 10:00:00'", s="id", extra="'z'")
    part(spark, folder, "c", fmt, k="cast(id AS double) / 2", d="id", s="true")
    part(spark, folder, "d", fmt, k="cast(id AS smallint)")
    got = read_files(spark, f"{folder}/*", f"*.{fmt}", fmt)
    assert dict(got.dtypes) == {
        "k": "double", "d": "decimal(21,2)", "t": "timestamp_ntz", "s": "string", "n": "struct<x:bigint>", "extra": "string",
    }
    assert sorted(r["k"] for r in got.collect()) == sorted([*range(3)] * 3 + [0, 0.5, 1]) and got.count() == 12
    assert got.filter("s = 'true'").count() == 3 and got.filter("extra = 'z' AND t = '2024-01-01 10:00:00'").count() == 3
    part(spark, folder, "e", fmt, n="array(id)")
    with pytest.raises(ValueError, match="do not combine"):
        read_files(spark, f"{folder}/*", f"*.{fmt}", fmt)


def test_wider_types():
    assert wider("c", {"int", "float"}) == "double" and wider("c", {"smallint", "float"}) == "float"
    assert wider("c", {"decimal(10,2)", "bigint"}) == "decimal(21,2)" and wider("c", {"decimal(38,2)", "decimal(38,20)"}) == "double"
    assert wider("c", {"date", "timestamp"}) == "timestamp" and wider("c", {"boolean", "int"}) == "string"


@pytest.mark.parametrize("fmt", ["parquet", "orc"])
@pytest.mark.parametrize("named", [500, 0])
def test_files_broken_anywhere_are_left_out_whole(spark, folder, monkeypatch, fmt, named):
    """Damage in the last of several row groups, a cut file, one that is something else; the scan of the rest stays strict."""
    from contract.damage import damage

    monkeypatch.setattr(files_module, "MOST_NAMED", named)
    wide = spark.range(4000).select("id", F.sha2(F.col("id").cast("string"), 256).alias("v"))
    for name in "abc":
        wide.coalesce(1).write.options(**{"parquet.block.size": 4096, "parquet.block.size.row.check.min": 50, "orc.stripe.size": 8192}).format(
            fmt).save(f"{folder}/{name}")
    bad = spark.read.format("binaryFile").option("pathGlobFilter", f"*.{fmt}").load(f"{folder}/a").select("path")
    bad.mapInArrow(damage(fmt), "path string").collect()
    (cut,) = [f"{folder}/b/{f}" for f in os.listdir(f"{folder}/b") if f.endswith(fmt) and not f.startswith(".")]
    os.truncate(cut, os.path.getsize(cut) * 2 // 3)
    put(folder, f"c/other.{fmt}", "not a table")
    if fmt == "parquet":
        import pyarrow.parquet as pq

        (several,) = [f for f in os.listdir(f"{folder}/c") if f.startswith("part") and f.endswith(fmt)]
        assert pq.read_metadata(f"{folder}/c/{several}").num_row_groups > 1
    got = read_files(spark, f"{folder}/*", f"*.{fmt}", fmt, skip_errors=True)
    assert got.count() == 4000 and got.select("v").distinct().count() == 4000
    spark.range(2).selectExpr("cast(id AS double) AS id", "map('k', id) AS m").coalesce(1).write.format(fmt).save(f"{folder}/d")
    got = read_files(spark, f"{folder}/*", f"*.{fmt}", fmt, skip_errors=True)
    assert got.count() == 4002 and dict(got.dtypes)["id"] == "double"
    with pytest.raises(Exception):
        read_files(spark, f"{folder}/*", f"*.{fmt}", fmt).count()
