"""License scan."""

import random

import pytest

from tidemark.llm import license


def test_exact_changed_and_absent(spark):
    t = license.TEMPLATES
    rows = [
        (1, "Prose first.\n" + t["apache-2.0"] + "\nmore prose"),
        (2, "intro " * 50 + t["gpl-3.0"] + " outro" * 50),
        (3, "Licenced under an Apache License, Version 2.0"),  # one word of eight changed beyond, one spelt differently
        (4, "licensed drivers released the general public"),
        (5, None), (6, ""), (None, t["mit"]), (7, t["mit"]), (7, t["mit"]),
        (8, t["mit"] + " " + t["cc-by-nc-4.0"] + "\n" + t["isc"].upper().replace(",", "")),
        (9, "plain words\n" * 30_000 + t["mpl-2.0"]),
    ]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as block", "2 as rank", "'x' as license_id")
    got = license.scan_licenses(df).collect()
    exact = sorted((str(r.doc_id), r.block, r.license_id) for r in got if r.exact)
    assert exact == sorted([
        ("1", 1, "apache-2.0"), ("2", 0, "gpl-3.0"), ("None", 0, "mit"), ("7", 0, "mit"), ("7", 0, "mit"),
        ("8", 0, "mit"), ("8", 0, "cc-by-nc-4.0"), ("8", 1, "isc"), ("9", 30_000, "mpl-2.0"),
    ])
    assert all(r.differences <= 0.2 * r.template_words for r in got)
    assert not any(r.doc_id in (4, 5, 6) for r in got)
    changed = [r for r in got if r.doc_id == 3]
    assert not any(r.exact for r in changed)
    assert next(r.start for r in got if r.doc_id == 9) == 12 * 30_000


def test_gpl_and_lgpl_are_told_apart(spark):
    t = license.TEMPLATES
    df = spark.createDataFrame([(1, t["gpl-3.0"]), (2, t["lgpl-3.0"])], "doc_id long, text string")
    best = {r.doc_id: r for r in license.scan_licenses(df).collect() if r.rank == 1}
    assert best[1].license_id == "gpl-3.0" and best[2].license_id == "lgpl-3.0" and best[1].exact and best[2].exact
    near = [r for r in license.scan_licenses(df).collect() if r.rank == 2]
    assert {(r.doc_id, r.license_id, r.missing, r.added) for r in near} <= {(1, "lgpl-3.0", "lesser", ""), (2, "gpl-3.0", "", "lesser")} and near


def test_every_wording_within_a_fifth_is_found():
    scanner = license.LicenseScanner(license.TEMPLATES)
    for name, text in license.TEMPLATES.items():
        words = text.split()
        for i in range(len(words)):
            changed = " ".join(words[:i] + ["zzz"] + words[i + 1 :])
            hits = {r[2]: r for r in scanner.scan(f"before it {changed} and after")}
            if len(license._words(words[i])) == 1:
                assert name in hits and hits[name][7] <= 0.2 * len(scanner.words[name])


def test_no_rows_and_own_templates(spark):
    df = spark.createDataFrame([(1, "all rights reversed by the house")], "doc_id long, text string")
    assert license.scan_licenses(df.where("false")).count() == 0
    own = license.scan_licenses(df, {"house": "All rights reversed by the house"}).collect()
    assert [(r.license_id, r.exact) for r in own] == [("house", True)]


def _varied(n, seed):
    rnd = random.Random(seed)
    return ["".join(rnd.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rnd.randint(2, 9))) for _ in range(n)]


@pytest.mark.parametrize("n", [100, 300, 600, 1500, 5000, 20_000])
def test_exact_statement_in_a_line_of_any_length(n):
    scanner = license.LicenseScanner(license.TEMPLATES)
    for name, text in license.TEMPLATES.items():
        words = _varied(n, f"{name}{n}")
        for place in (0, n // 2, n):
            hits = scanner.scan(" ".join(words[:place] + [text] + words[place:]))
            best = [h for h in hits if h[2] == name]
            assert len(best) == 1 and best[0][3] == 1 and best[0][10], (name, place, hits)
            assert best[0][5] > 0.35  # the bytes saved do not depend on the line


def test_statements_of_a_line_each_give_a_row():
    scanner = license.LicenseScanner(license.TEMPLATES)
    t, prose = license.TEMPLATES["mit"], " ".join(_varied(400, 5))
    assert [h[2] for h in scanner.scan(f"{t} {t} {prose} {t}") if h[10]] == ["mit"] * 3


@pytest.mark.parametrize("mark", ["", "# ", " * ", "// ", "    ; "])
def test_statements_wrapped_over_lines(mark):
    scanner = license.LicenseScanner(license.TEMPLATES)
    for name, text in license.TEMPLATES.items():
        words = text.split()
        for width in (1, 2, 4, 9):
            lines = [mark + " ".join(words[i : i + width]) for i in range(0, len(words), width)]
            hits = scanner.scan("\n".join([mark + "Some file.", mark, *lines, mark, mark + "It follows."]))
            best = [h for h in hits if h[2] == name]
            assert len(best) == 1 and best[0][10], (name, width, hits)
            assert best[0][0] == 2 and best[0][1] == len(mark + "Some file.\n" + mark + "\n")


def test_full_texts_and_notices_by_default(spark):
    rows = [(i, "a file of words\n" + text.replace(", ", ",\n# ") + "\nand more") for i, text in enumerate(license.NOTICES.values())]
    got = license.scan_licenses(spark.createDataFrame(rows, "doc_id long, text string")).where("exact").collect()
    found = {(r.doc_id, r.license_id) for r in got}
    assert found >= set(enumerate(license.NOTICES))
    assert {"mit:text", "bsd-2-clause:conditions", "apache-2.0:header", "agpl-3.0:notice", "mpl-2.0:spdx", "cc-by-sa-4.0:deed"} <= set(license.NOTICES)


def test_exact_wording_wins_and_no_other_license_is_told():
    scanner = license.LicenseScanner(license.TEMPLATES | license.NOTICES)
    prose = " ".join(_varied(60, 3))
    for name, text in (license.TEMPLATES | license.NOTICES).items():
        told = scanner.scan(f"{prose}\n{text}\n{prose}", near=False)
        assert [(h[2], h[10], h[12]) for h in told] == [(name, True, True)], (name, told)
        first = [h for h in scanner.scan(f"{prose}\n{text}\n{prose}") if h[3] == 1]
        assert [h[2] for h in first] == [name], (name, first)


@pytest.mark.parametrize("text", [
    "SPDX-License-Identifier: GPL-1.0-only", "SPDX-License-Identifier: Apache-1.1", "Licensed under CC BY-NC-SA 4.0.",
    "https://creativecommons.org/licenses/by-nc/3.0/", "Released under the XYZ License.",
    license.NOTICES["lgpl-2.1:notice"].replace("2.1", "2.0"), license.NOTICES["gpl-3.0:notice"].replace("version 3", "version 3.1"),
])
def test_other_versions_and_clauses_win_nothing(text):
    scanner = license.LicenseScanner(license.TEMPLATES | license.NOTICES)
    assert scanner.scan(f"some words before\n{text}\nand after", near=False) == []


def test_longer_inexact_wording_holds_a_shorter_exact_one():
    scanner = license.LicenseScanner(license.TEMPLATES | license.NOTICES)
    bsd3 = license.NOTICES["bsd-3-clause:conditions"].replace("the copyright holder nor", "Acme Corporation nor")
    bsd2 = license.NOTICES["bsd-2-clause:conditions"].replace("retain the above", "keep the above")
    assert [(h[2], h[10]) for h in scanner.scan(bsd3, near=False)] == [("bsd-3-clause:conditions", False)]
    assert [(h[2], h[10]) for h in scanner.scan(bsd2, near=False)] == [("bsd-2-clause:conditions", False)]


def test_against_alignment_at_every_place():
    """Key words, counts of words held and blocks lose nothing that an alignment anywhere would find."""
    templates = license.TEMPLATES | {k: v for k, v in license.NOTICES.items() if len(v) < 300}
    scanner = license.LicenseScanner(templates)
    rnd = random.Random(11)
    for trial in range(12):
        words = _varied(25, trial)
        for name in rnd.sample(sorted(templates), 2):
            put = license._words(templates[name])
            for _ in range(rnd.randint(0, 2)):
                put[rnd.randrange(len(put))] = rnd.choice(["the", "license", "zz", "4"])
            at = rnd.randint(0, len(words))
            words[at:at] = put
        best = {}
        for name in scanner.words:
            width = len(scanner.words[name]) + scanner._slack(name)
            found = [r[0] for i in range(len(words)) if (r := scanner._align(name, words[i : i + width])) and r[0] <= scanner._slack(name)]
            if found:
                best[name] = min(found)
        got = {}
        for h in scanner.scan(" ".join(words)):
            got[h[2]] = min(h[7], got.get(h[2], 99))
        assert got == best, (trial, words)


def test_many_statements_in_one_text():
    scanner = license.LicenseScanner(license.TEMPLATES | license.NOTICES)
    text = " ".join(f"{license.TEMPLATES['mit']} x{i}" for i in range(4000))
    told = scanner.scan(text, near=False)
    assert [h[2] for h in told] == ["mit"] * 4000
