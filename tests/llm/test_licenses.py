import pytest

from tidelog.llm import licenses

from .conftest import prose


def _one(text):
    return [(h["license"], h["wording"]) for h in licenses.Scanner().scan(text)]


@pytest.mark.parametrize("name", sorted(licenses.TEMPLATES))
def test_every_template_is_found(name):
    for i, t in enumerate(licenses.TEMPLATES[name]):
        text = prose(1, 40) + ".\n" + t + "\n" + prose(2, 40)
        found = _one(text)
        assert len(found) == 1 and found[0][0] == name and found[0][1] == i


def test_wording_decides():
    assert _one("This work is licensed under the GNU General Public License, version 2.") == [("GPL-2.0", 0)]
    assert _one("This work is licensed under the GNU General Public License, version 3.") == [("GPL-3.0", 0)]
    hit = licenses.Scanner().scan(licenses.TEMPLATES["MIT"][2].replace("free of charge", "at no charge"))[0]
    assert hit["license"] == "MIT" and hit["coverage"] < 1 and hit["changes"] == ["-free of +at no"]
    assert _one("You need permission to license this, with no warranty, said the man.") == []
    assert _one("x" * 10_000 + ". " + licenses.TEMPLATES["CC-BY-NC-4.0"][0] + " " + "y" * 10_000) == [("CC-BY-NC-4.0", 0)]


def test_headers_of_long_texts():
    for name, i in (("Apache-2.0", 0), ("Apache-2.0", 1), ("MIT", 2)):
        header = licenses.TEMPLATES[name][i] + "\n"
        for before in ("", prose(3, 3000) + ".\n"):
            hit = licenses.Scanner().scan(before + header + ". ".join(prose(s, 40) for s in range(100)))
            assert [(h["license"], h["wording"]) for h in hit] == [(name, i)]
            assert hit[0]["begin"] == len(before) and hit[0]["end"] <= len(before + header)


def test_several_licenses_in_a_block():
    names = sorted(licenses.TEMPLATES)
    assert _one("Released under the MIT License. Licensed under the Apache License, Version 2.0.") == [("MIT", 0), ("Apache-2.0", 0)]
    assert _one(" ".join(licenses.TEMPLATES[n][0] for n in names)) == [(n, 0) for n in names]
    assert _one((licenses.TEMPLATES["MIT"][0] + " ") * 30) == [("MIT", 0)] * 30
    # A short notice between hinted sentences that no template says.
    text = "Copyright notices of other people follow, and a warranty is not given by any of them. " * 5
    hit = licenses.Scanner().scan(text + licenses.TEMPLATES["MIT"][1] + " " + text)
    assert [(h["license"], h["wording"], h["begin"], h["end"]) for h in hit] == [("MIT", 1, len(text), len(text) + 30)]


def test_no_edge_cuts_a_notice():
    line = "Every copyright belongs to whoever wrote it. "
    bsd, bare = licenses.TEMPLATES["BSD-3-Clause"][1], licenses.TEMPLATES["Apache-2.0"][1].replace(".", "")
    for n in range(5300, 6100, 150):
        for text, name in ((line * (n // len(line)) + bsd + " " + line * 200, "BSD-3-Clause"), (prose(4, 2000)[:n] + " " + bare + " " + prose(5, 2000), "Apache-2.0")):
            assert [h["license"] for h in licenses.Scanner().scan(text)] == [name]


def test_headers_and_full_texts_are_told_apart():
    for name in ("AGPL-3.0", "LGPL-2.1", "LGPL-3.0", "GPL-2.0", "GPL-3.0"):
        for text in (licenses.TEMPLATES[name][1], licenses.TEMPLATES[name][1].replace("This ", "The ")):
            assert _one(prose(1, 40) + ".\n" + text + " " + prose(2, 400)) == [(name, 1)]
    assert {"ISC", "Unlicense", "EPL-2.0", "LGPL-2.1"} <= set(licenses.TEMPLATES)
    for name, text in licenses.BODIES.items():
        found = _one(prose(1, 40) + ".\n" + text + "\n" + prose(2, 40) + ". Released under the MIT License.")
        assert found == [(name, len(licenses.TEMPLATES.get(name, []))), ("MIT", 0)]


def test_rows(spark, docs, none):
    rows = [(1, "a\n" + licenses.TEMPLATES["Apache-2.0"][0]), (1, "a\n" + licenses.TEMPLATES["Apache-2.0"][0]), (2, None), (3, ""), (None, licenses.TEMPLATES["MIT"][0])]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = licenses.scan_licenses(df).collect()
    assert sorted((r.doc_id or 0, r.license) for r in got) == [(0, "MIT"), (1, "Apache-2.0"), (1, "Apache-2.0")]
    assert all(r.begin <= r.end for r in got)
    assert licenses.scan_licenses(docs).count() == 0 and licenses.scan_licenses(none).count() == 0
