import os
import textwrap

import pytest

from quarry.llm import licenses as L

MIT = next(b for i, k, b in L.KNOWN if i == "MIT" and k == "text")


def test_whole_texts_and_lines(spark):
    rows = [
        (1, MIT, 0), (2, "Copyright (c) 2020 A. Person\n\n" + MIT.upper().replace("\n\n", "\n \n"), 0),
        (3, MIT.replace('"', "").replace(",", " ,"), 0), (4, MIT + " And more.", 0),
        (5, "Some text.\nReleased under the MIT Licence!\nreleased under the mit license\nLicensed under CC BY-NC 4.0.\nEnd.", 0),
        (6, None, 0), (7, "", 0), (8, "!!!\n\n", 0), (9, "Released under the MIT License.", 0), (9, "Released under the MIT License.", 0),
        (10, "x " * 60000, 0), (None, "SPDX-License-Identifier: Apache-2.0", 0),
    ]
    df = spark.createDataFrame(rows, "doc_id long, text string, license_id int")
    out = {}
    for r in L.scan_licenses(df).collect():
        out.setdefault(r["doc_id"], []).append(r)
    lic = {k: v[0]["license_id"] for k, v in out.items()}
    assert [lic[k] for k in (1, 2, 3, 4, 5)] == ["MIT", "MIT", "MIT", None, None]
    assert out[1][0]["text_digest"] == out[2][0]["text_digest"] == out[3][0]["text_digest"]
    assert (out[5][0]["notice_ids"], out[5][0]["n_notice_lines"]) == ("CC-BY-NC-4.0,MIT", 3)
    for k in (6, 7, 8, 10):
        assert out[k][0]["license_id"] is None and out[k][0]["n_notice_lines"] == 0 and out[k][0]["notice_ids"] == ""
    assert len(out[9]) == 2 and out[9][0]["license_id"] == "MIT" and out[9][0]["n_notice_lines"] == 1
    assert lic[None] == "Apache-2.0"
    assert L.scan_licenses(df.limit(0)).count() == 0


def test_own_list_of_known_texts(spark):
    df = spark.createDataFrame([(1, "My own Licence, v. 1")], "doc_id long, text string")
    assert L.scan_licenses(df, known=[("own", "text", "my own license V 1")]).first()["license_id"] == "own"


def wrapped(text: str, width: int) -> str:
    return "\n\n".join(textwrap.fill(p, width) for p in text.split("\n\n"))


def test_wrapping_titles_and_copyright_lines_make_no_difference(spark):
    heads = ["", "Copyright (c) 2021 The Holder <x@y.z>\n\n", "Copyright 2019-2020 Someone\nAll rights reserved.\n\n",
             "Copyright (C) <year> <holder> All\r\nrights reserved.\n"]
    rows = []
    for i, kind, body in L.KNOWN:
        if kind == "text":
            for w in range(60, 101):
                for k, t in enumerate((body, body.split("\n\n", 1)[1])):
                    rows.append((i, heads[(w + k) % len(heads)] + wrapped(t, w)))
    assert len(rows) == 6 * 41 * 2
    out = L.scan_licenses(spark.createDataFrame(rows, "doc_id string, text string"))
    assert out.where("license_id is null or license_id <> doc_id").count() == 0


def test_a_copyright_in_the_middle_of_a_sentence_stays(spark):
    rows = [(1, "in no event shall the authors or\ncopyright holders be liable"), (2, "in no event shall the authors or"),
            (3, "(c) You must retain it"), (4, "You must retain it")]
    d = {r["doc_id"]: r["text_digest"] for r in L.scan_licenses(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert len(set(d.values())) == 4


@pytest.mark.parametrize("name,file", [("Apache-2.0", "Apache-2.0"), ("GPL-2.0", "GPL-2"), ("GPL-3.0", "GPL-3"), ("LGPL-2.1", "LGPL-2.1"),
                                       ("LGPL-3.0", "LGPL-3"), ("MPL-2.0", "MPL-2.0"), ("CC0-1.0", "CC0-1.0")])
def test_long_licences_by_digest(spark, name, file):
    path = f"/usr/share/common-licenses/{file}"
    if not os.path.exists(path):
        pytest.skip("this system has no copy of the text")
    with open(path, encoding="utf-8") as f:
        text = f.read()
    rows = [(1, text), (2, "\n".join(x.strip() for x in text.upper().split("\n"))), (3, text[:-200])]
    out = {r["doc_id"]: r["license_id"] for r in L.scan_licenses(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert out == {1: name, 2: name, 3: None}


def test_the_scan_is_native_and_moves_no_row(spark):
    df = spark.createDataFrame([(1, "x")], "doc_id long, text string")
    plan = L.scan_licenses(df)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan
    assert "SortMergeJoin" not in plan
