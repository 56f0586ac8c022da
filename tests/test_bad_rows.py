"""Rows that can't be read: refused with their text, or left out and listed; nothing vanishes."""

import pytest

from searchloom.sources import csv_logs, ranked_lists

VISITS = "URL,Size,OutLinks,ContentType\na,12,3,text/html\nb,12x,3,text/html\nc,7,x,t\nd,1\ne,1,2,t,more\nf,,2,\n\n"


def visits(tmp_path):
    (tmp_path / "visit").mkdir()
    (tmp_path / "visit" / "log.csv").write_text(VISITS)
    return str(tmp_path / "visit")


def test_bad_log_rows_end_the_job_with_their_text(spark, tmp_path):
    with pytest.raises(Exception, match="a bad row in the visit log: b,12x,3,text/html"):
        csv_logs.read_log(spark, "visit", visits(tmp_path)).collect()


def test_a_count_of_another_column_ends_too(spark, tmp_path):
    with pytest.raises(Exception, match="a bad row in the visit log"):
        csv_logs.read_log(spark, "visit", visits(tmp_path)).select("content_type").distinct().count()


def test_bad_log_rows_are_left_out_or_listed(spark, tmp_path):
    path = visits(tmp_path)
    good = csv_logs.read_log(spark, "visit", path, bad_rows="drop")
    assert sorted(map(tuple, good.collect())) == [("a", 12, 3, "text/html"), ("f", None, 2, "")]
    bad = csv_logs.bad_log_rows(spark, "visit", path)
    assert sorted(map(tuple, bad.collect())) == [("log.csv", r) for r in ("b,12x,3,text/html", "c,7,x,t", "d,1", "e,1,2,t,more")]
    assert bad.count() == 4
    with pytest.raises(ValueError):
        csv_logs.read_log(spark, "visit", path, bad_rows="keep")


LINES = ['{"q": ["a", "b"], "none": []}', '{"r": ["c"]', "no json", '{"n": 5}', "[1]", "", " ", '{"s": ["d"]}', "null"]


def lists(tmp_path):
    (tmp_path / "lists").mkdir()
    (tmp_path / "lists" / "lists.json").write_text("\n".join(LINES))
    return str(tmp_path / "lists")


def test_bad_lists_end_the_job_with_their_text(spark, tmp_path):
    with pytest.raises(Exception, match="no object of ranked lists"):
        ranked_lists.read_ranked_lists(spark, lists(tmp_path)).collect()


def test_bad_lists_are_left_out_or_listed(spark, tmp_path):
    path = lists(tmp_path)
    good = ranked_lists.read_ranked_lists(spark, path, bad_rows="drop")
    assert sorted((r.query, list(r.urls)) for r in good.collect()) == [("none", []), ("q", ["a", "b"]), ("s", ["d"])]
    bad = ranked_lists.bad_ranked_lists(spark, path)
    assert sorted(map(tuple, bad.collect())) == sorted(("lists.json", LINES[i]) for i in (1, 2, 3, 4, 8))
    with pytest.raises(ValueError):
        ranked_lists.read_ranked_lists(spark, path, bad_rows="keep")
