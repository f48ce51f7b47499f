import os
import zipfile

import pytest
from pyspark.sql import functions as F

from lodestrata.functions.flatten import flatten_json
from lodestrata.sources import archives
from lodestrata.sources import files as S
from lodestrata.sources import named_files as N


@pytest.fixture
def tree(tmp_path):
    for name, text in {
        "src/A.cs": b"class A {}\n", "src/bin/B.cs": b"x", "tests/T.cs": b"x", "Specifications/S.cs": b"x", "src/x.min.js": b"x", "src/data.bin": b"a\0b",
        "src/ru.txt": "\u043f\u0440\u0438\u0432\u0435\u0442 \u043c\u0438\u0440".encode(), "src/crlf.md": b"a\r\nb\r\n",
    }.items():
        (tmp_path / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / name).write_bytes(text)
    return str(tmp_path)


def test_scan_and_inventory(spark, tree):
    files = S.scan(spark, tree)
    assert {r["path"] for r in S.source_files(files).collect()} == {"src/A.cs", "src/data.bin", "src/ru.txt", "src/crlf.md"}
    assert "tests/T.cs" in {r["path"] for r in S.source_files(files, include_tests=True).collect()}
    by = {r["path"]: r for r in S.inventory(files).collect()}
    assert by["src/A.cs"]["language"] == "csharp" and by["src/A.cs"]["line_count"] == 1 and not by["src/A.cs"]["ignored"]
    assert by["src/bin/B.cs"]["ignore_reason"] == "ignored_directory:bin" and by["src/x.min.js"]["ignore_reason"] == "ignored_file:minified_js"
    assert by["src/data.bin"]["line_count"] is None and by["src/ru.txt"]["line_count"] is None and by["src/crlf.md"]["line_count"] == 2
    assert by["src/A.cs"]["hash"].startswith("sha256:") and len(by["src/A.cs"]["hash"]) == 71


def test_resolve(tmp_path):
    assert S.resolve_source(str(tmp_path))["source_type"] == "directory"
    with zipfile.ZipFile(tmp_path / "r.zip", "w") as z:
        z.writestr("root/a.txt", "x")
    assert S.resolve_source(str(tmp_path / "r.zip"))["local_path"].endswith("root")
    for bad in ("/no/such", "https://host/x/y"):
        with pytest.raises(ValueError):
            S.resolve_source(bad)


def test_parameters_of_all_formats(spark):
    rows = [
        ("a.json", "json", '{"A": {"B": [1, {"C": null}]}, "api-key": "s"}'), ("b.yml", "yaml", "x:\n  - 1\n  - y: two\n"), ("w.config", "xml", '<c><appSettings><add key="k" value="v"/></appSettings><connectionStrings><add name="n" connectionString="cs"/></connectionStrings></c>'),
        ("bad.json", "json", "{"), ("l.yml", "yaml", "- 1"), ("n.json", "json", None),
    ]
    got = {(r["path"], r["key"]): (r["value"], r["error"]) for r in S.parameters(spark.createDataFrame(rows, "path string, format string, text string")).collect()}
    assert got[("a.json", "A.B[0]")] == ("1", None) and got[("a.json", "A.B[1].C")] == ("", None) and got[("a.json", "api-key")] == ("***REDACTED***", None)
    assert got[("b.yml", "x[1].y")] == ("two", None) and got[("w.config", "k")] == ("v", None) and got[("w.config", "n")] == ("cs", None)
    assert got[("bad.json", None)][1] == "JSONDecodeError" and ("l.yml", None) not in got and ("n.json", None) in got


def test_key_values_solutions_packages_projects(spark):
    text = lambda rows: spark.createDataFrame(rows, "path string, text string")
    got = [tuple(r) for r in S.key_values(text([(".env", "# c\n\nA = 'x=y'\nplain\n")]), quoted=True).collect()]
    assert got == [(".env", 3, "A", "x=y")]
    got = [tuple(r) for r in S.solution_projects(text([("a.sln", 'Project("{1}") = "Web", "src\\Web\\Web.csproj", "{2}"')])).collect()]
    assert got == [("a.sln", "Web", "src/Web/Web.csproj")]
    by = {r["path"]: (r["framework"], r["packages"], r["confidence"]) for r in S.packages(text([("p", '{"dependencies": {"react": "1"}, "devDependencies": {"vite": "2"}}'), ("q", "{}"), ("r", "{")])).collect()}
    assert by["p"] == ("React", ["react", "vite"], 0.9) and by["q"] == ("unknown", [], 0.75) and by["r"][2] == 0.2
    project = '<Project Sdk="Microsoft.NET.Sdk.Web"><PropertyGroup><TargetFrameworks>net8.0;net9.0</TargetFrameworks></PropertyGroup><ItemGroup><PackageReference Include="B"/><ProjectReference Include="..\\A\\A.csproj"/></ItemGroup></Project>'
    by = {r["path"]: r for r in S.project_files(text([("p", project), ("bad", "<x")])).collect()}
    assert by["p"]["frameworks"] == ["net8.0", "net9.0"] and by["p"]["packages"] == ["B"] and by["p"]["project_references"] == ["../A/A.csproj"] and by["bad"]["error"] == "ParseError"


def test_flatten(spark):
    rows = spark.createDataFrame([(1, '{"a": {"b": [1, {"c": null}]}, "d": "x"}'), (2, "nope"), (3, None)], "id long, doc string")
    assert {tuple(r) for r in flatten_json(rows, "doc", "id").collect()} == {(1, "a.b[0]", "1"), (1, "a.b[1].c", ""), (1, "d", "x")}


def test_contract(spark):
    df = spark.range(1)
    assert S.check_contract(df, ["id"], "t") == [] and S.check_contract(df, ["x"], "t") == ["t: column x is missing"] and S.check_contract(df.limit(0), ["id"], "t") == ["t: no rows"]


def zipped(path, entries):
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        for name, content in entries:
            z.writestr(name, content)
    return str(path)


def test_an_archive_is_scanned_where_it_lies(spark, tmp_path):
    entries = [("root/", b"")] + [(f"root/d{k % 3}/f{k}.cs", f"class A{k} {{}}\n".encode() * (k + 1)) for k in range(40)] + [("root/empty.txt", b""), ("root/twice.md", b"one"), ("root/\u00e9\u65e5.bin", bytes(range(256)))]
    path = zipped(tmp_path / "r.zip", entries)
    with pytest.warns(UserWarning), zipfile.ZipFile(path, "a") as z:
        z.writestr("root/twice.md", b"two!")
    archives.register(spark)
    frame = spark.read.format("zip_entries").option("partition_bytes", "2000").load(path)
    want = {name: content for name, content in entries if not name.endswith("/")} | {"root/twice.md": b"two!"}
    assert {r["path"]: bytes(r["content"]) for r in frame.collect()} == want and all(r["length"] == len(r["content"]) for r in frame.collect()) and frame.rdd.getNumPartitions() > 3
    at = S.resolve_source(path)["local_path"]
    files = S.scan(spark, at)
    assert {r["path"] for r in files.collect()} == {n[5:] for n, c in want.items() if c} and {r["path"] for r in S.scan(spark, f"{path}!/root/d1").collect()} == {f"f{k}.cs" for k in range(40) if k % 3 == 1}
    assert {r["language"] for r in S.inventory(files).where("path LIKE '%.cs'").collect()} == {"csharp"}
    assert {r["path"] for r in spark.read.format("zip_entries").load(f"file://{path}").collect()} == set(want)
    assert os.listdir(tmp_path) == ["r.zip"]


@pytest.mark.parametrize("name", ["../up.txt", "/abs.txt", "a/../../b", "C:/x", "..\\w.txt", "a\\..\\..\\b"])
def test_paths_that_leave_an_archive_are_refused(spark, tmp_path, name):
    path = zipped(tmp_path / "bad.zip", [("fine.txt", b"x"), (name, b"x")])
    with pytest.raises(ValueError):
        S.resolve_source(path)
    with pytest.raises(Exception, match="unsafe path"):
        S.scan(spark, path).collect()
    assert os.listdir(tmp_path) == ["bad.zip"]


def files_in(folder):
    return {os.path.relpath(os.path.join(d, n), folder): open(os.path.join(d, n), "rb").read() for d, _, names in os.walk(folder) for n in names}


def test_named_files_and_their_bytes(spark, tmp_path):
    rows = [(f"d{k % 4}/{k}.md", f"text {k} \u00e9\n".encode() * k) for k in range(50)] + [("top.bin", bytes(range(256)))]
    N.save(spark.createDataFrame(rows, "name string, content binary").repartition(6), f"{tmp_path}/out")
    assert files_in(tmp_path / "out") == dict(rows) and os.listdir(tmp_path) == ["out"]
    N.save(spark.createDataFrame([("top.bin", b"new"), ("more", None)], "name string, content binary"), f"file://{tmp_path}/out")
    assert files_in(tmp_path / "out") == dict(rows) | {"top.bin": b"new", "more": b""}
    last = N.last_of_each(spark.createDataFrame([("a", b"1", 1), ("a", b"3", 3), ("a", b"2", 2)], "name string, content binary, seq long"), "seq")
    assert [bytes(r["content"]) for r in last.collect()] == [b"3"]


def test_names_of_many_files_stay_out_of_the_driver(spark, tmp_path, monkeypatch):
    """Files are moved and read by tasks, a bounded number each; the writer hands over ids of attempts alone."""
    monkeypatch.setattr(N, "NAMES_A_TASK", 10)
    rows = spark.range(200).selectExpr("concat('a/', id, '.txt') AS name", "cast(concat('text ', id) AS binary) AS content").coalesce(1)
    N.save(rows, f"{tmp_path}/out")
    found = N.contents(rows.select("name"), f"{tmp_path}/out")
    assert found.rdd.getNumPartitions() == 20
    assert {r["name"]: bytes(r["content"]) for r in found.collect()} == {f"a/{k}.txt": f"text {k}".encode() for k in range(200)} and os.listdir(tmp_path) == ["out"]
    writer = N.NamedFilesWriter(f"{tmp_path}/more", f"{tmp_path}/more.staging-x")
    message = writer.write(iter([("a", b"1"), ("b/c", b"2")]))
    writer.commit([message])
    assert message.names == [] and not os.path.exists(tmp_path / "more")
    move = N._mover(f"{tmp_path}/more.staging-x", f"{tmp_path}/more")
    move(message.attempt)
    move(message.attempt)  # the task ran again
    assert files_in(tmp_path / "more") == {"a": b"1", "b/c": b"2"}
    with pytest.raises(Exception):
        N.contents(spark.createDataFrame([("gone",)], "name string"), f"{tmp_path}/out").collect()


@pytest.mark.parametrize("bad", ["../x", "/x", "", None, "dup"])
def test_a_failed_write_leaves_nothing(spark, tmp_path, bad):
    rows = [(f"f{k}", b"x") for k in range(20)] + [("dup", b"1"), (bad, b"2")]
    with pytest.raises(Exception):
        N.save(spark.createDataFrame(rows, "name string, content binary").repartition(4), f"{tmp_path}/out")
    assert files_in(tmp_path) == {}


def test_attempts_that_are_lost_leave_nothing(tmp_path):
    writer = N.NamedFilesWriter(f"{tmp_path}/out")
    lost = iter([("a", b"lost"), ("b", b"lost")])
    writer.write(lost)  # its message never arrives: the task runs again
    with pytest.raises(ValueError):
        writer.write(iter([("c", b"half"), ("..", b"x")]))
    done = [writer.write(iter([("a", b"1"), ("s/b", b"2")])), writer.write(iter([])), None]
    assert not os.path.exists(tmp_path / "out")
    writer.commit(done)
    assert files_in(tmp_path) == {"out/a": b"1", "out/s/b": b"2"}


def test_contracts_from_one_pass(spark, tmp_path):
    table = spark.createDataFrame([(1, '{"a": 1}'), (None, "{"), (3, None)], "id long, doc string")
    contract = S.Contract("t", table, ["id", "doc"], ["id"], ["doc"])
    want = ["t: 1 rows without id", "t: 1 rows of doc are no JSON"]
    assert [r["problem"] for r in S.contract_problems([contract, S.Contract("u", table, ["x", "y"]), S.Contract("v", table.limit(0), ["id"], ["id"])]).collect()] == [*want, "u: column x is missing", "u: column y is missing", "v: no rows"]
    assert S.write_phase({"t": table, "free": table}, str(tmp_path), {"t": contract}) == want and spark.read.parquet(f"{tmp_path}/t").count() == 3
    assert S.write_phase({"t": table.where("id = 1")}, str(tmp_path), {"t": contract}) == []


def test_texts_are_made_in_many_tasks(spark, monkeypatch):
    from lodestrata.plans import bridge

    monkeypatch.setattr(bridge, "TEXTS_A_PART", 10)
    rows = bridge.texts(spark, "/root/testdata/sf0.001", bridge.CS)
    assert rows.select(F.spark_partition_id().alias("p")).distinct().count() > 8
    assert rows.exceptAll(bridge.source(spark, "/root/testdata/sf0.001", bridge.CS)).count() == 0 and rows.count() == 200


def test_yaml_is_read_by_libyaml_and_refused_as_before(monkeypatch):
    import yaml

    from lodestrata.sources import files

    for text in ("a: [1, 2", "a: 1\n\tb: 2", "- x", "", "a: {b: [c, 'd']}\ne: 2024-01-01\nf: !!int '3'\ng: &x 1\nh: *x"):
        try:
            want = yaml.safe_load(text)
        except yaml.YAMLError as error:
            with pytest.raises(type(error)):
                files._yaml(text)
        else:
            assert files._yaml(text) == want

    def slow(_):
        raise AssertionError("parsed in Python")

    monkeypatch.setattr(yaml, "safe_load", slow)
    assert files._yaml("a:\n  b: 1\n") == {"a": {"b": 1}}
