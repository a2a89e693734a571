from cartwise.sources import read_delimited, read_delimited_checked


def _write(tmp_path, text, name="tb_regions.csv"):
    p = tmp_path / name
    p.write_text(text, encoding="utf-8")
    return str(p)


def test_pipe_text(spark, tmp_path):
    path = _write(tmp_path, '"PK"|"p_code"\n77|visa\n78|"pay|later"\n', "modes.csv")
    rows = read_delimited(spark, path, ["PK", "p_code"]).orderBy("PK").collect()
    assert [tuple(r) for r in rows] == [("77", "visa"), ("78", "pay|later")]


def test_each_file_has_its_own_header(spark, tmp_path):
    _write(tmp_path, "PK|p_code\n1|A\n", "a.csv")
    _write(tmp_path, "p_code|PK\nB|2\n", "b.csv")
    _write(tmp_path, "PK|note|p_code\n3|x|C|more\n", "c.csv")
    rows, long_rows = read_delimited_checked(spark, str(tmp_path), ["PK", "p_code"])
    assert sorted(tuple(r) for r in rows.collect()) == [("1", "A"), ("2", "B"), ("3", "C")]
    assert [r["PK"] for r in long_rows.collect()] == ["3"]


def test_line_breaks_in_quotes_on_request(spark, tmp_path):
    path = _write(tmp_path, 'PK|p_code\n1|"two\nlines"\n2|b\n', "m.csv")
    rows = read_delimited(spark, path, ["PK", "p_code"], multi_line=True).orderBy("PK").collect()
    assert [tuple(r) for r in rows] == [("1", "two\nlines"), ("2", "b")]


def test_ragged_rows_and_quotes(spark, tmp_path):
    text = '"PK"|"p_isocode"|"p_isocodeshort"\n1|BR-SP|SP\n2|BR-RJ\n3|BR-MG|MG|extra\n4|"p|q"|z\n'
    path = _write(tmp_path, text)
    rows, long_rows = read_delimited_checked(spark, path, ["PK", "p_isocode", "p_isocodeshort"])
    got = {r["PK"]: (r["p_isocode"], r["p_isocodeshort"]) for r in rows.collect()}
    assert got == {"1": ("BR-SP", "SP"), "2": ("BR-RJ", None), "3": ("BR-MG", "MG"), "4": ("p|q", "z")}
    assert [r["PK"] for r in long_rows.collect()] == ["3"]


def test_null_tokens(spark, tmp_path):
    path = _write(tmp_path, "PK|p_code\n1|NA\n2|\n3|x\n")
    rows = read_delimited(spark, path, ["PK", "p_code"], null_tokens=("", "NA")).orderBy("PK").collect()
    assert [r["p_code"] for r in rows] == [None, None, "x"]
    rows = read_delimited(spark, path, ["PK", "p_code"]).orderBy("PK").collect()
    assert [r["p_code"] for r in rows] == ["NA", None, "x"]


def test_columns_by_header_name(spark, tmp_path):
    text = '"p_isocodeshort"|"extra"|"PK"|"p_isocode"\nSP|x|1|BR-SP\nRJ|y|2|BR-RJ|surplus\n'
    path = _write(tmp_path, text)
    rows, long_rows = read_delimited_checked(spark, path, ["PK", "p_isocode", "p_isocodeshort"])
    assert sorted(tuple(r) for r in rows.collect()) == [("1", "BR-SP", "SP"), ("2", "BR-RJ", "RJ")]
    assert [r["PK"] for r in long_rows.collect()] == ["2"]


def test_missing_declared_column_fails(spark, tmp_path):
    import pytest

    path = _write(tmp_path, "PK|p_code\n1|a\n")
    with pytest.raises(ValueError, match="p_isocode"):
        read_delimited(spark, path, ["PK", "p_isocode"]).collect()


def _scanned_rows(df):
    """Rows that the scans of an executed plan handed on."""
    found, nodes = [], [df._jdf.queryExecution().executedPlan()]
    while nodes:
        node = nodes.pop()
        if node.nodeName().startswith("Scan"):
            found.append(node.metrics().get("numOutputRows").get().value())
        nodes += [node.children().apply(i) for i in range(node.children().size())]
    return sum(found)


def test_headers_are_found_without_a_data_scan(spark, tmp_path):
    from cartwise.sources.delimited import _whole_files, header_lines

    for name in ("a.csv", "b c.csv"):
        path = _write(tmp_path, "PK|p_code\n" + "".join(f"{i}|code {i}\n" for i in range(300_000)), name)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    with _whole_files(spark):
        heads = header_lines(spark, [str(tmp_path / "a.csv"), path])
        assert [r["head"] for r in heads.collect()] == ["PK|p_code"] * 2
        assert _scanned_rows(heads) < 100  # of 600,002
    assert spark.conf.get("spark.sql.files.maxPartitionBytes") == before
    rows, _ = read_delimited_checked(spark, str(tmp_path), ["PK", "p_code"])
    assert rows.count() == 600_000
    assert rows._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1
