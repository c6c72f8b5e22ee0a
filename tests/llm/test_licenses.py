from __future__ import annotations

from quotelake.llm import licenses
from tests.llm.helpers import ODD_ROWS, documents, prose

MIT = licenses.KNOWN_TEXTS["MIT"]


def scan(spark, rows, known=None):
    found = licenses.scan_licenses(documents(spark, rows), known or licenses.known_licenses(spark))
    return {row.doc_id: row for row in found.collect()}


def test_whole_texts_in_other_dress(spark):
    rows = [
        (1, MIT),
        (2, "Copyright (c) 2020 Somebody\n\n" + MIT.upper()),
        (3, "# " + MIT.replace("\n", "\n# ").replace('"', "“")),
        (4, "All rights reserved.\n" + MIT.replace(" ", "\n", 5)),
        (5, MIT.replace("copies", "fopies")),
        (6, MIT + "\n" + prose(1, 10)),
        (7, "© 1999 X\nlicenced  under THE Apache licence, version 2.0!"),
        (8, "Licensed under the Apache License, Version 2.0."),
    ]
    got = scan(spark, rows)
    assert [got[i].license_id for i in range(1, 9)] == ["MIT"] * 4 + [None] * 2 + ["Apache-2.0"] * 2


def test_spellings_and_body_lines(spark):
    known = spark.createDataFrame([("X", "The above copyright notice of the license holder")], "license_id string, text string")
    got = scan(spark, [(1, "the above COPYRIGHT NOTICE of the licence holder"), (2, "the above notice of the license holder")], known)
    assert (got[1].license_id, got[2].license_id) == ("X", None)


def test_notices_below_a_text(spark):
    line = licenses.KNOWN_TEXTS["MIT-notice"]
    got = scan(spark, [(1, f"{prose(1, 30)}\n{line}\n{line}\nLicensed under CC BY-NC 4.0"), (2, prose(2, 30))])
    assert (got[1].license_id, got[1].n_notices, got[1].notices) == (None, 3, "CC-BY-NC-4.0,MIT-notice")
    assert (got[2].n_notices, got[2].notices) == (0, "")


def test_odd_rows_and_repeats(spark):
    line = licenses.KNOWN_TEXTS["MIT-notice"]
    rows = documents(spark, [*ODD_ROWS, (9, f"x\n{line}"), (9, f"x\n{line}"), (9, f"x {line}")])
    found = licenses.scan_licenses(rows, licenses.known_licenses(spark)).collect()
    assert len(found) == len(ODD_ROWS) + 3
    assert sorted(row.n_notices for row in found if row.doc_id == 9) == [0, 1, 1]
    assert all(row.canonical_sha256 is None for row in found if row.doc_id in (1, 2, 3))
    assert sum(row.doc_id is None for row in found) == 1
    assert licenses.scan_licenses(rows.limit(0), licenses.known_licenses(spark)).collect() == []


def test_beyond_the_broadcast_bound_and_without_known(spark, monkeypatch):
    monkeypatch.setattr(licenses, "BROADCAST_ROWS", 0)
    assert scan(spark, [(1, MIT), (2, "x")])[1].license_id == "MIT"
    none = licenses.known_licenses(spark).limit(0)
    assert scan(spark, [(1, MIT)], none)[1].license_id is None


def test_no_python_on_the_main_path(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet")
    plan = licenses.scan_licenses(rows, licenses.known_licenses(spark))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan


def test_whole_licence_files_with_their_titles(spark):
    rows, wanted = [], {}
    for name, titles in licenses.TITLES.items():
        for title in (*titles, ""):
            at = len(rows)
            wanted[at] = name
            rows.append((at, f"{title}\n\nCopyright (c) 2021 Some Holder\n\n{licenses.KNOWN_TEXTS[name]}\n"))
    got = scan(spark, rows)
    assert {at: row.license_id for at, row in got.items()} == wanted
    assert scan(spark, [(1, "MIT License")])[1].license_id is None
