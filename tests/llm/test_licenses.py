"""Licence scan: real licence files, headers and tags, inheritance, similarities by brute force, odd tables."""

import math
import re
from collections import Counter

import duckdb
import pytest

from strata.llm import licenses, queries

T = licenses.TEMPLATES
MIT_FILE = "MIT License\n\nCopyright (c) 2021 Jane Doe and the Frobnicator contributors\n\n" + T["MIT"][0].replace(". ", ".\n\n") + "\n"
BSD_FILE = "Copyright (c) 2019, Some Company Inc.\nAll rights reserved.\n\n" + T["BSD-3-Clause"][0]
APACHE_HEADER = "# Copyright 2020 The Frob Authors\n#\n# " + T["Apache-2.0"][1].replace(", ", ",\n# ") + "\n\nimport os\n" + "def frob(x): return x + 1\n" * 200
SCHEMA = "doc_id long, path string, text string"


def scan(spark, rows, **more):
    return licenses.licence_scan(spark.createDataFrame(rows, SCHEMA), "path", **more)


def test_files_headers_tags_and_inheritance(spark):
    rows = [
        (1, "/a/LICENSE", MIT_FILE), (2, "/a/x.py", "code"), (3, "/a/b/y.py", "code"), (4, "/a/b/c/COPYING", T["GPL-3.0"][0] + "\n\n" + "preamble " * 500),
        (5, "/a/b/c/d/z.py", None), (6, "/q/z.py", "code"), (7, "/a/w.py", APACHE_HEADER), (8, None, ""),
        (9, "/u/LICENSE", "Our own licence forbids everything on Tuesdays."), (10, "/u/v.py", "code"),
        (11, "/a/k.c", "// SPDX-License-Identifier: Apache-2.0\nint main;\n"), (12, "/a/l.c", "/* SPDX-License-Identifier: GPL-2.0-or-later */\nint main;"),
        (13, "/a/m.py", "# Copyright 2020 Jane Doe\nx = 1\n"), (14, "/bsd/thelicence", BSD_FILE), (15, "/bsd/n.py", "code"),
        (16, "/a/o.py", "# SPDX-License-Identifier: LicenseRef-Proprietary\n"), (17, "/a/bc/p.py", "code"), (18, "/ab/q.py", "code")]
    got = {r.doc_id: r for r in scan(spark, rows).collect()}
    short = {k: (r.licence, r.origin, r.licence_dir) for k, r in got.items()}
    assert short[1][:2] == ("MIT", "own") and short[2] == ("MIT", "inherited", "/a") and short[3] == ("MIT", "inherited", "/a")
    assert short[4][:2] == ("GPL-3.0", "own") and short[5] == ("GPL-3.0", "inherited", "/a/b/c") and short[6] == (None, "none", None)
    assert short[7][:2] == ("Apache-2.0", "own") and short[8] == (None, "none", None)
    # A notice that no template explains is no licence, and doesn't block the one of the directory.
    assert short[9] == (None, "none", None) and got[9].notice and short[10][1] == "none"
    assert short[13] == ("MIT", "inherited", "/a") and got[13].notice and short[16] == ("MIT", "inherited", "/a")
    assert short[11][:2] == ("Apache-2.0", "own") and short[12][:2] == ("GPL-2.0", "own")
    # A licence file by its text, whatever its name; a source file with a header isn't one ('/a' stays MIT).
    assert short[14][:2] == ("BSD-3-Clause", "own") and short[15] == ("BSD-3-Clause", "inherited", "/bsd")
    assert short[17] == ("MIT", "inherited", "/a") and short[18] == (None, "none", None)  # a directory isn't a prefix of names


def test_every_template_is_its_own_licence(spark):
    made = licenses.bodies(T)
    rows = [(i, f"/{i}/f", body) for i, (_, body) in enumerate(made)]
    got = {r.doc_id: r.licence for r in scan(spark, rows).collect()}
    assert [got[i] for i in range(len(made))] == [name for name, _ in made]


def brute(rows, least):
    made = [(name, Counter(re.findall(licenses.WORD, body.lower()))) for name, body in licenses.bodies(T)]
    low = str.maketrans(licenses.UPPER, licenses.LOWER)
    all_words = [set(re.findall(licenses.WORD, (t or "").translate(low))) for _, _, t in rows]
    vocabulary = set().union(*[c for _, c in made])
    idf = {w: math.log((1 + len(rows)) / (1 + sum(w in ws for ws in all_words))) + 1 for w in vocabulary}
    other = math.log(1 + len(rows)) + 1
    out = {}
    for k, _, text in rows:
        text = text or ""
        found = []
        for n, part in enumerate([text, *re.split(licenses.BREAK, text), *text.split("\n")]):
            c = Counter(re.findall(licenses.WORD, part.translate(low)))
            own = math.sqrt(sum((m * idf[w]) ** 2 if w in idf else m * other ** 2 for w, m in c.items()))
            for name, t in made:
                dot = sum(c[w] * m * idf[w] ** 2 for w, m in t.items())
                if dot and (n or t.total() >= licenses.FULL_WORDS):
                    found.append((-round(dot / own / math.sqrt(sum((m * idf[w]) ** 2 for w, m in t.items())), 6), name))
        best = min(found, default=(0, None))
        out[k] = (best[1], -best[0]) if -best[0] >= least else (None, 0)
    return out


@pytest.mark.parametrize("least", [0.3, 0.6, 0.9])
def test_similarities_equal_brute_force(spark, least):
    # Words cut out of templates and mixed with prose, so that many parts are near the threshold.
    pieces = [body.split() for _, body in licenses.bodies(T)]
    prose = "the of and to in a is that for it under any with or you Straße naïve software work code".split()
    rows = []
    for i in range(120):
        p = pieces[i % len(pieces)]
        cut = p[i % 3: max(3, len(p) * (1 + i % 5) // 5)]
        lines = [" ".join(cut), " ".join(prose[i % 7:]), "", "# --", " ".join(cut[::2] + prose[: i % 9])]
        rows.append((i, f"/{i}/f", "\n".join(lines[i % 2:])))
    rows += [(900, "/x/a", None), (901, "/x/b", ""), (902, "/x/c", "the of and " * 5000)]
    got = {r.doc_id: (r.licence if r.origin == "own" else None, r.similarity) for r in scan(spark, rows, least=least).collect()}
    want = brute(rows, least)
    assert {k: (v[0], pytest.approx(v[1], abs=2e-6)) for k, v in want.items()} == got
    assert 10 < sum(v[0] is not None for v in want.values())


def test_odd_tables(spark):
    # Null and repeated ids, repeated rows, clashing column names, a very long text, ties.
    line = "Released under the MIT License."
    rows = [(None, "/n/LICENSE", line), (None, "/n/x", "code"), (1, "/r/x", line), (1, "/r/x", line), (2, None, "x " * 400000 + "\n" + line)]
    files = spark.createDataFrame([(*r, "w", 1, True, 2.0) for r in rows], SCHEMA + ", licence string, k int, whole boolean, `a.b` double")
    got = licenses.licence_scan(files, "path")
    assert got.columns == ["doc_id", "licence", "origin", "similarity", "licence_dir", "notice"]
    assert [(r.doc_id, r.licence, r.origin) for r in got.collect()].count((1, "MIT", "own")) == 2 and got.count() == 5
    assert all(r.licence == "MIT" and r.origin == "own" for r in got.collect())  # rows of one id share the best match
    assert licenses.licence_scan(files.limit(0), "path").count() == 0
    # One directory with two licence files of equal similarity: the first name.
    tie = [(1, "/t/LICENSE", "Released under the MIT License."), (2, "/t/COPYING", "Released under the ISC License."), (3, "/t/x", "code")]
    r = {x.doc_id: x for x in scan(spark, tie).collect()}
    assert r[1].similarity == r[2].similarity == 1.0 and r[3].licence == "ISC"


def test_words_without_which_nothing_matches(spark):
    made = licenses.counted(T)
    idf = {w: 1.0 if w in ("the", "of", "and", "to", "in") else 9.0 for w in set().union(*[c for _, c in made])}
    needed = licenses.distinctive(made, idf, 0.6)
    assert "the" not in needed and "mit" in needed
    assert licenses.distinctive(made, idf, 0.0) == sorted(idf)  # with no threshold every word can decide


def test_plan_is_native(spark):
    plan = queries.op4_licenses(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|ExistingRDD|Pandas|Arrow|NestedLoop|Cartesian", plan)


def test_sql_agrees(spark):
    con = duckdb.connect()
    con.execute("CREATE VIEW documents AS SELECT * FROM read_parquet('/root/testdata/sf0.001/documents.parquet')")
    got = queries.op4_licenses(spark, "/root/testdata/sf0.001")
    rel = con.execute(queries.SQL["op4_licenses"])
    names = [c[0] for c in rel.description]
    assert sorted(map(str, (tuple(r) for r in got.select(*names).collect()))) == sorted(map(str, rel.fetchall()))
