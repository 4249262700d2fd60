"""Licence scans: alignment beside plain subsequences, planted notices, odd rows."""

import random
import re

import pytest

from trainflow.llm import licenses
from trainflow.llm.catalog import op6_license_scan
from trainflow.llm.license_texts import MIT, TEXTS


def lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        last = 0
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], last + 1 if x == y else max(row[j], row[j - 1])
    return row[-1]


@pytest.mark.parametrize("seed", range(5))
def test_alignment_rises_and_nearly_reaches_the_longest_subsequence(seed):
    rng = random.Random(seed)
    template = [rng.randrange(40) for _ in range(60)]
    text = [w for w in template if rng.random() > 0.1]
    for _ in range(6):
        text.insert(rng.randrange(len(text)), rng.randrange(60))
    pairs = licenses.aligned(text, template)
    assert all(text[i] == template[j] for i, j in pairs)
    assert all(a < c and b < d for (a, b), (c, d) in zip(pairs[:-1], pairs[1:], strict=True))
    assert 0.85 * lcs(text, template) <= len(pairs) <= lcs(text, template)


def test_longest_rising_part():
    pairs = list(enumerate([5, 1, 2, 9, 3, 4, 0, 8]))
    assert [b for _, b in licenses._increasing(pairs)] == [1, 2, 3, 4, 8]
    assert licenses._increasing([]) == []


def prose(rng, n):
    return " ".join(rng.choices("the of and in anthe oned erin this is by work under any software public".split(), k=n))


def test_planted_texts_are_found_and_prose_is_left_alone():
    rng = random.Random(1)
    for name, text in TEXTS:
        changed = text.split()
        if len(changed) > 30:
            for _ in range(len(changed) // 15):
                changed[rng.randrange(len(changed))] = "other"
        body = f"{prose(rng, 400)}É {' '.join(changed)} {prose(rng, 300)}\n"
        found = [f for f in licenses.scan([body.encode()])[0] if f[0] == name]
        assert found and found[0][1] >= 0.8
        start = body.index("É ") + 2
        assert abs(found[0][2] - start) < 120 and abs(found[0][3] - start - len(" ".join(changed))) < 120
    assert licenses.scan([prose(rng, 3000).encode()]) == [[]]


def test_notice_repeated_many_times():
    line = "Released under the MIT License."
    found = licenses.scan([(f"{line}\n" * 50).encode()])[0]
    assert len(found) == 50 and all(f[:2] == ("MIT", 1.0) for f in found)


def test_query_finds_the_lines_of_the_table(spark):
    folder = "/root/testdata/sf0.01"
    lines = {
        "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
        "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
        "MIT": "Released under the MIT License.",
        "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    }
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    rows = op6_license_scan(spark, folder).collect()
    assert len(rows) == len(docs)
    for r in rows:
        text = docs[r.doc_id] or ""
        assert (r.n_licenses > 0) == any(x in text for x in lines.values())
        for name, x in lines.items():
            assert all(f"{name}:{m.start()}:{m.end() - 1}" in r.licenses for m in re.finditer(re.escape(x), text))
    assert any(r.n_licenses for r in rows)


def test_odd_rows(spark):
    rows = [(None, MIT, "x"), (1, None, "y"), (1, "", "y"), (2, MIT * 200, None), (3, "license " * 10_000, "z")]
    df = spark.createDataFrame(rows, "doc_id long, text string, name string")
    found = licenses.with_licenses(df)
    assert found.columns == ["doc_id", "text", "name", "licenses"]
    sizes = sorted((r.doc_id or 0, r.text or "", len(r.licenses)) for r in found.collect())
    assert [n for _, _, n in sizes] == [1, 0, 0, 200, 0]
    assert licenses.with_licenses(df.limit(0)).count() == 0


@pytest.mark.parametrize("size", [200, 500])
def test_large_gaps_without_words_of_their_own_are_aligned(size):
    rng = random.Random(size)
    template = rng.choices(range(20), k=size)
    text = rng.choices(range(20), k=size + 50)
    pairs = licenses.aligned(text, template)
    assert len(pairs) == lcs(text, template) > size / 3
    assert all(text[i] == template[j] for i, j in pairs)
    assert all(a < c and b < d for (a, b), (c, d) in zip(pairs[:-1], pairs[1:], strict=True))


def names(text):
    return [f[0] for f in licenses.scan([text.encode()])[0]]


def test_whole_texts_are_told_apart():
    """Versions and relatives of a licence are reported as such, and nothing besides, without their notices."""
    rng = random.Random(3)
    texts = {(name, text) for name, text in TEXTS if len(text.split()) > 60}
    assert {n for n, _ in texts} >= {"MIT", "BSD-2-Clause", "BSD-3-Clause", "Apache-2.0", "GPL-2.0", "GPL-3.0", "LGPL-2.1"}
    assert {n for n, _ in texts} >= {"LGPL-3.0", "AGPL-3.0", "MPL-2.0", "CC0-1.0", "CC-BY-SA-4.0", "Unlicense", "ISC"}
    for name, text in sorted(texts):
        body = text[: text.index("END OF TERMS")] if "END OF TERMS" in text else text
        assert names(f"{prose(rng, 300)}\n{body}\n{prose(rng, 300)}") == [name]
    gpl_2 = "This program is free software; either version 2 of the License, or (at your option) any later version."
    assert names(gpl_2) == []  # too little of the notice


def test_two_licences_in_one_text():
    rng = random.Random(4)
    whole = dict(TEXTS[::-1])
    both = f"{whole['BSD-3-Clause']}\n{prose(rng, 50)}\n{MIT}\n{prose(rng, 50)}\n{whole['BSD-2-Clause']}"
    assert names(both) == ["BSD-3-Clause", "MIT", "BSD-2-Clause"]


@pytest.mark.parametrize(
    ("text", "expected"),
    [
        ("Licensed under the Apache License, Version 2.0.", ["Apache-2.0"]),
        ("This work is licensed under the GNU General Public License, version 3.", ["GPL-3.0"]),
        ("This work is licensed under the GNU General Public License, version 2.", ["GPL-2.0"]),
        ("Licensed under the GNU Lesser General Public License, version 2.1.", ["LGPL-2.1"]),
        ("Released under the Apache License", []),
        ("Licensed under CC BY 4.0", ["CC-BY-4.0"]),
        ("Licensed under CC BY-NC 4.0.", ["CC-BY-NC-4.0"]),
        ("Licensed under CC BY-NC-SA 4.0.", ["CC-BY-NC-SA-4.0"]),
        ("Released under MIT License", ["MIT"]),
        ("Licensed under the MIT License or the Apache License, Version 2.0", ["MIT", "Apache-2.0"]),
        ("The MIT License is mentioned only.", []),
    ],
)
def test_notices_need_the_name_and_version(text, expected):
    assert names(text) == expected


def test_query_gives_nothing_but_the_lines_of_the_table(spark):
    """The whole string of every document beside plain searches for the lines that the tables hold."""
    folder = "/root/testdata/sf0.01"
    lines = {
        "This work is licensed under the GNU General Public License, version 3": "GPL-3.0",
        "Licensed under CC BY-NC 4.0": "CC-BY-NC-4.0",
        "Released under the MIT License": "MIT",
        "Licensed under the Apache License, Version 2.0": "Apache-2.0",
    }
    pattern = re.compile("|".join(map(re.escape, lines)))
    docs = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    for r in op6_license_scan(spark, folder).collect():
        found = [f"{lines[m[0]]}:{m.start()}:{m.end()}" for m in pattern.finditer(docs[r.doc_id])]
        assert (r.n_licenses, r.licenses) == (len(found), ",".join(found))
