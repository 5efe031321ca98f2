import pytest

from tallyline.sources import add_ingestion_metadata, malformed, read_batch_csv, read_checked_csv, read_checked_json, well_formed

GOOD = ["1,2,3", '1,"two, 2",3', ",,", '7,8,"9"', '5,6"6,7', "1,2,", '"a\\"b",2,3', '"","",""', "x\\,y,2,3".replace("\\,", "-"), '"q""x",2,3']
BAD = [
    ("1,2", "too_few_fields"), ("1,2,3,4", "too_many_fields"), ('1,2,"three', "bad_quote"), ('4,"unterminated,6', "bad_quote"), ('"x"y,2,3', "bad_quote"),
    ('"open', "bad_quote"), ("one", "too_few_fields"), ('"a,b",2', "too_few_fields"), (",,,,", "too_many_fields"),
]


def test_broken_csv_lines_are_told_apart(spark, tmp_path):
    (tmp_path / "a.csv").write_text("\n".join(["a,b,c", *GOOD, "", *[x for x, _ in BAD]]) + "\n")
    (tmp_path / "b.csv").write_text("a,b,c\n8,8,8\n")
    found = read_checked_csv(spark, str(tmp_path), ["a", "b", "c"])
    assert found.columns == ["a", "b", "c", "parse_error", "raw_line"]
    assert sorted((r.raw_line, r.parse_error) for r in malformed(found).collect()) == sorted(BAD)
    assert all(r.a is None and r.b is None and r.c is None for r in malformed(found).collect())
    good = well_formed(found)
    (tmp_path / "good").mkdir()
    (tmp_path / "good" / "x.csv").write_text("\n".join(["a,b,c", *GOOD, "8,8,8"]) + "\n")
    plain = read_batch_csv(spark, str(tmp_path / "good"), ["a", "b", "c"])
    assert sorted(map(str, good.collect())) == sorted(map(str, plain.collect()))
    assert found.count() == len(GOOD) + len(BAD) + 1


def test_lineage_of_broken_lines(spark, tmp_path):
    (tmp_path / "a.csv").write_text("a,b\n1,2\n3\n")
    found = add_ingestion_metadata(read_checked_csv(spark, str(tmp_path), ["a", "b"]), "s", "l", None, ["a", "b"])
    plain = add_ingestion_metadata(read_batch_csv(spark, str(tmp_path), ["a", "b"]), "s", "l")
    line = malformed(found).first()
    assert line.source_file_name.endswith("a.csv") and line.raw_line == "3"
    assert found.where("a = 1").first().record_hash == plain.where("a = 1").first().record_hash


@pytest.mark.parametrize("sep", ["|", ";", "\t"])
def test_other_separators(spark, tmp_path, sep):
    (tmp_path / "a.csv").write_text(sep.join("abc") + "\n" + sep.join("123") + f'\n"x{sep}y"{sep}2{sep}3\n1{sep}2\n')
    found = read_checked_csv(spark, str(tmp_path), ["a", "b", "c"], sep)
    assert sorted((r.a, r.c) for r in well_formed(found).collect()) == [("1", "3"), (f"x{sep}y", "3")]
    assert [r.parse_error for r in malformed(found).collect()] == ["too_few_fields"]


def test_very_long_lines(spark, tmp_path):
    long = "x" * 300_000
    quoted = '"' + "a,b " * 60_000 + '"'
    escaped = '"' + 'a\\"' * 60_000 + '"'
    (tmp_path / "a.csv").write_text(f"a,b\n{long},1\n{quoted},2\n{escaped},3\n{quoted}\n")
    found = read_checked_csv(spark, str(tmp_path), ["a", "b"])
    assert sorted(r.b for r in well_formed(found).collect()) == ["1", "2", "3"]
    assert [r.parse_error for r in malformed(found).collect()] == ["too_few_fields"]


def test_broken_json_lines(spark, tmp_path):
    lines = ['{"a":"1","b":2,"z":3}', '{"a":"1"', "[1]", '{"a":1,"b":{"x":1}}', "not json", "", "  ", "{}", "null", '{"a":null}']
    (tmp_path / "a.json").write_text("\n".join(lines) + "\n")
    found = read_checked_json(spark, str(tmp_path), ["a", "b"])
    assert sorted(map(str, ((r.a, r.b) for r in well_formed(found).collect()))) == sorted(map(str, [("1", "2"), ("1", '{"x":1}'), (None, None), (None, None)]))
    assert sorted(r.raw_line for r in malformed(found).collect()) == sorted(['{"a":"1"', "[1]", "not json", "null"])
    assert {r.parse_error for r in malformed(found).collect()} == {"not_a_json_object"}
