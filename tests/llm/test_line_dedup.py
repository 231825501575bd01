"""Line dedup: edge cases; the whole query is compared with SQL."""

import pytest

from stockflow.llm.line_dedup import dedup_lines
from tests.llm.cases import documents

LONG = " ".join(f"l{i}" for i in range(55))
HALF = " ".join(f"h{i}" for i in range(30))
REST = " ".join(f"r{i}" for i in range(30))


def run(spark, texts, **options):
    rows = dedup_lines(documents(spark, texts), **options).collect()
    got = {r["doc_id"]: (r["text"], r["n_lines"], r["n_deleted"]) for r in rows}
    return [got[i] for i in range(len(texts))]


def test_runs_go_but_in_the_first_place(spark):
    texts = [
        f"top\n{LONG}\nend",
        f"other\n {LONG} \nlast",
        f"{HALF}\n\n{REST}\ntail one",
        f"start\n{HALF}\n\n{REST}\ntail two",
        f"{HALF}\nalone",
        f"{LONG}\n{LONG}",
        "short\nshort",
    ]
    assert run(spark, texts) == [
        (texts[0], 3, 0),
        ("other\nlast", 3, 1),
        (texts[2], 4, 0),
        ("start\ntail two", 5, 3),
        (texts[4], 2, 0),
        ("", 2, 2),
        (texts[6], 2, 0),
    ]


def test_run_is_extended_to_its_short_ends(spark):
    run_ = f"a b c\n{HALF}\n{REST}\nd e"
    assert run(spark, [f"{run_}\nx", f"y\n{run_}\nz"])[1] == ("y\nz", 6, 4)


def test_null_empty_repeated(spark):
    got = run(spark, [None, "", LONG, LONG, "\n\n"])
    assert got == [(None, 0, 0), ("", 1, 0), (LONG, 1, 0), ("", 1, 1), ("\n\n", 3, 0)]
    docs = spark.createDataFrame([(1, LONG), (1, LONG), (None, None)], "doc_id bigint, text string")
    assert sorted(r["n_deleted"] for r in dedup_lines(docs).collect()) == [0, 0, 1]
    assert dedup_lines(docs.limit(0)).count() == 0
    with pytest.raises(ValueError):
        dedup_lines(docs, least=0)


def test_main_path_is_native(spark, capsys):
    dedup_lines(documents(spark, [LONG, LONG])).explain("formatted")
    plan = capsys.readouterr().out
    assert "Python" not in plan and "Arrow" not in plan and "CartesianProduct" not in plan
