import random
from datetime import datetime

import pytest

from siltstone.llm import licences as L


def plain_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def test_bit_parallel_distance():
    rng = random.Random(5)
    for _ in range(500):
        a, b = ([rng.choice("abcd") for _ in range(rng.randrange(9))] for _ in range(2))
        node = L._Node(tuple(a), "x")
        assert L.token_distance(node.masks, len(a), tuple(b)) == plain_distance(a, b)


def test_tree_agrees_with_a_scan():
    tree, rng = L.TemplateTree(), random.Random(6)
    words = sorted(tree.vocabulary) + ["other", "4"]
    templates = [(tuple(t.split()), n) for n, ts in L.WORDINGS.items() for t in ts]
    for _ in range(300):
        base = list(rng.choice(templates)[0])
        if rng.random() < 0.7:
            base[rng.randrange(len(base))] = rng.choice(words)
        tokens = tuple(base)
        bound = min(L.BOUND, len(tokens) // 5)
        numbers = [t for t in tokens if t[0].isdigit()]
        near = [(plain_distance(t, tokens), n) for t, n in templates if [x for x in t if x[0].isdigit()] == numbers]
        near = [x for x in near if x[0] <= bound]
        assert tree.nearest(tokens) == (min(near) if near else None)


HEADS = {
    "// SPDX-License-Identifier: Apache-2.0\nint a;": ["Apache-2.0"],
    "# Licensed under the GNU General Public License version 3.\nx": ["GPL-3.0-only"],
    "/*\n * Some Org, 2020. This file may be used under the terms of the\n * MIT licence; see the page.\n */\nint a;": ["MIT"],
    "// Licensed under the Apache-2.0 or MIT license, at your option.\n": ["Apache-2.0 OR MIT"],
    "// MIT OR Apache-2.0 license\n": ["Apache-2.0 OR MIT"],
    "// License: LGPLv2.1\n": ["LGPL-2.1-only"],
    "// License: GPLv3\n": ["GPL-3.0-only"],
    "// License: GPL-3.0-or-later\n": ["GPL-3.0-or-later"],
    "// under the three-clause BSD license and the MPL v2.0\n": ["BSD-3-Clause", "MPL-2.0"],
    "// Automatisch erzeugt mit tool\nint a;": [],
    "int a; // MIT License\n": [],
    "// Copyright 2020 Org. All rights reserved.\n": [],
    "": [],
    None: [],
}


@pytest.mark.parametrize("text", HEADS)
def test_heads(text):
    assert L.header_names(text) == HEADS[text]


def test_declared_and_files():
    assert L.declared_names(["Expat", "mit", "NOASSERTION", None, "unknown", "no_license"]) == ["MIT"]
    assert L.declared_names(["MIT OR Apache-2.0", "apache 2.0"]) == ["Apache-2.0", "Apache-2.0 OR MIT"] and L.declared_names(None) == []
    assert L.licence_file_names("Copyright 2020 Org\n\nMIT LICENCE\n\nYou may use it.\n") == ["MIT"]
    assert L.licence_file_names("Org publishes this under the Unlicense.\n") == ["Unlicense"] and L.licence_file_names("TBD\n") == [] and L.licence_file_names(None) == []


FILES = "document_id string, repo_id string, license_type string, content string, detected_licenses array<string>"
SNAPSHOTS = "repo_id string, snapshot_at timestamp, files array<struct<content string, file_path string>>"


def test_verdicts(spark):
    mit, gpl = "// SPDX-License-Identifier: MIT\n", "// SPDX-License-Identifier: GPL-3.0-only\n"
    rows = [
        ("one", "r1", None, mit, None),
        ("same", "r1", "permissive", mit, ["Expat"]),
        ("type", "r2", "copyleft", mit, []),
        ("fits", "r2", "copyleft", gpl, []),
        ("two", "r2", None, mit, ["ISC"]),
        ("repo", "r1", "no_license", "x", None),
        ("against", "r1", None, gpl, None),
        ("none", "r2", "permissive", None, ["NOASSERTION"]),
        ("lost", None, None, mit, None),
    ]
    old, new = datetime(2020, 1, 1), datetime(2021, 1, 1)
    snaps = [("r1", new, [("MIT License", "LICENSE.md"), ("GPLv3", "third_party/x/LICENSE")]), ("r1", old, [("ISC License", "COPYING")]), ("r1", new, [("MIT License", "LICENSE.md"), ("GPLv3", "third_party/x/LICENSE")]), ("r2", None, []), ("r3", new, [("MIT", "licence"), ("ISC License", "Copying.txt")]), ("r4", new, None)]
    files, snapshots = spark.createDataFrame(rows, FILES), spark.createDataFrame(snaps, SNAPSHOTS)
    repos = L.repo_evidence(snapshots)
    got = {r["document_id"]: r["verdict"] for r in L.file_verdicts(L.file_evidence(files, ["document_id", "repo_id", "license_type"]), repos).collect()}
    assert got == {"one": "MIT", "same": "MIT", "type": "conflict", "fits": "GPL-3.0-only", "two": "conflict", "repo": "MIT", "against": "conflict", "none": "unknown", "lost": "MIT"}
    of_repos = {r["repo_id"]: r["verdict"] for r in L.repo_verdicts(files, repos).collect()}
    assert of_repos == {"r1": "MIT", "r2": "unknown", "r3": "conflict", "r4": "unknown"}
    assert L.repo_verdicts(files.limit(0), L.repo_evidence(snapshots.limit(0))).count() == 0


@pytest.mark.parametrize("top", ["# word of a notice\n" * 79 + "# {}\nx = 1\n", "/*\n" + " * word of a notice\n" * 78 + " * {}\n */\nint x;\n", "\n" * 79 + "// {}\nint x;\n"])
def test_licence_on_line_80(top):
    text = top.format("SPDX-License-Identifier: MIT")
    assert text.split("\n")[79].endswith("MIT")
    assert L.header_names(text) == ["MIT"]
    assert L.header_names(text.replace("\n", "\r\n")) == ["MIT"]
    assert L.header_names("// licensed under the ISC License\n" + text) == ["ISC", "MIT"]


BSD_END = "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS AS IS AND ANY EXPRESS OR IMPLIED WARRANTIES ARE DISCLAIMED."


def changed(text, share, rng):
    """A text with a share of its words replaced or left out."""
    out = []
    for w in text.split():
        x = rng.random()
        if x < share / 2:
            continue
        out.append(rng.choice(["our", "program", "such", "party"]) if x < share else w)
    return " ".join(out)


def wrapped(text, width=70):
    import textwrap

    return textwrap.fill(text, width)


@pytest.mark.parametrize("name", sorted(L.TEXTS))
def test_texts_without_a_title_are_known(name):
    rng = random.Random(7)
    hits = tries = 0
    for _ in range(10):
        body = "\n\n".join(wrapped(changed(p, 0.05, rng)) for p in L.TEXTS[name])
        tries += 1
        hits += L.licence_file_names(f"Copyright (c) 2020 Some Org\n\n{body}\n") == [name]
    assert hits >= 0.9 * tries


def test_texts_in_comments_and_lists():
    body = L.TEXTS["MIT"]
    head = "/*\n * Copyright 2020 Some Org\n *\n" + "".join(" *\n" + "".join(f" * {line}\n" for line in wrapped(p).split("\n")) for p in body) + " */\nint a;\n"
    assert L.header_names(head) == ["MIT"]
    items = L.TEXTS["BSD-3-Clause"][0].replace(" 1. ", "\n\n1. ").replace(" 2. ", "\n\n2. ").replace(" 3. ", "\n\n3. ")
    assert L.licence_file_names(f"Copyright 2020 Org\n\n{items}\n\n{BSD_END}\n") == ["BSD-3-Clause"]
    two = L.TEXTS["BSD-2-Clause"][0].replace(" 1. ", "\n\n1. ").replace(" 2. ", "\n\n2. ")
    assert L.licence_file_names(f"Copyright 2020 Org\n\n{two}\n\n{BSD_END}\n") == ["BSD-2-Clause"]
    assert L.licence_file_names("MIT License\n\n" + "\n\n".join(body)) == ["MIT"]
    assert L.licence_file_names("\n\n".join(body) + "\n\n" + "\n\n".join(L.TEXTS["ISC"])) == ["ISC", "MIT"]
    assert L.licence_file_names("Copies have to keep this notice. The authors give no warranty of any kind, and the software is provided without conditions.\n") == []


def test_text_index_agrees_with_a_scan():
    index, rng = L.TextIndex(), random.Random(8)
    templates = [(tuple(L.normalise(p)), n) for n, ps in L.TEXTS.items() for p in ps]
    for _ in range(60):
        tokens = tuple(L.normalise(changed(" ".join(rng.choice(templates)[0]), rng.choice([0.05, 0.2, 0.4]), rng)))
        bound = int(len(tokens) * L.TEXT_SHARE)
        near = [(plain_distance(t, tokens), n) for t, n in templates]
        near = [x for x in near if x[0] <= bound and len(tokens) >= L.SHORTEST_TEXT]
        assert index.nearest(tokens) == (min(near)[1] if near else None)


def test_a_wrong_letter_in_a_name():
    assert L.header_names("// Licensed under the GNU General Publik License version 3.\n") == ["GPL-3.0-only"]
