"""License scans: templates amid other text, inheritance from full texts, cosines by brute force."""

from __future__ import annotations

import math
import random
import re
from collections import Counter

from revspark.llm import license_texts as T
from revspark.llm.licenses import SHORT, SIMILARITY, Notices, licenses

FILES = "file_id long, path string, text string, license string, _dir string"


def files_of(spark, rows):
    return spark.createDataFrame([(*r, "x", "y") for r in rows], FILES)


def commented(text, mark):
    return "\n".join(f"{mark} {line}".rstrip() for line in text.strip().splitlines())


GPL3 = T._GNU_HEADER.format(work="program", name="General Public License", version="3")


def test_wrapped_headers_full_texts_and_tags(spark):
    rng = random.Random(3)
    prose = " ".join(f"w{rng.randrange(500)}" for _ in range(400))
    code = "\n".join(f"def f{n}(x):\n    return x + {n}" for n in range(60))
    rows = [
        (1, "a/LICENSE", "The MIT License (MIT)\n\nCopyright (c) 2020 Jane Doe\n" + T._MIT + T._MIT_REST),
        (2, "a/src/x.py", code),
        (3, "b/LICENSE", "Copyright 2019 Some Body. All rights reserved.\n" + T._BSD_OPENING + T._BSD_NAMES + T._BSD_REST),
        (4, "b/src/deep/x.py", code),
        (5, "c/x.py", commented(GPL3, "#") + "\n\n" + code),
        (6, "c/y.c", "// SPDX-License-Identifier: MIT\n" + code),
        (7, "c/z.md", f"{prose} This work is licensed under the GNU General Public License, version 2. {prose}"),
        (8, "c/plain.md", prose),
        (9, "d/opening.txt", T._MIT + "\n" + prose),
        (10, "d/apache.java", "/*\n" + commented(T._APACHE_HEADER, " *") + "\n */\n" + code),
        (11, "d/two.txt", "SPDX-License-Identifier: LGPL-2.1-or-later\n" + prose),
        (12, "d/other.txt", "SPDX-License-Identifier: Custom-1.7\n" + prose),
        (13, "d/talk.txt", "Everyone may copy this license document, said the author of the software. " + prose),
        (14, "e/COPYING", T._GNU_OPENING.format(name="Affero General Public License", version="3",
                                              date="19 November 2007", year="2007") + prose),
        (15, "e/f/x", ""), (16, "e/g/y", None), (17, None, T._MIT), (18, "h/bsd2", T._BSD_OPENING + T._BSD_REST)]
    got = {r.file_id: (r.license, r.origin, r.directory) for r in licenses(files_of(spark, rows)).collect()}
    own = {k: v[0] for k, v in got.items() if v[1] == "own"}
    assert own == {1: "MIT", 3: "BSD-3-Clause", 5: "GPL-3.0", 6: "MIT", 7: "GPL-2.0", 9: "MIT", 10: "Apache-2.0",
                   11: "LGPL-2.1", 14: "AGPL-3.0", 17: "MIT", 18: "BSD-2-Clause"}
    assert got[2] == ("MIT", "inherited", "a") and got[4] == ("BSD-3-Clause", "inherited", "b")
    assert got[15] == got[16] == ("AGPL-3.0", "inherited", "e")
    assert all(got[k] == (None, None, None) for k in (8, 12, 13))


def brute(notices, frequency, n, text, threshold):
    """The closest template over every window, worked out window by window."""
    words = lambda t: re.findall(r"\w+", t.lower())
    vocabulary = {w for _, t in notices for w in words(t)}
    idf = lambda w: math.log((n + 1) / ((frequency.get(w, 0) if w in vocabulary else 0) + 1)) + 1
    vector = lambda ws: {w: c * idf(w) for w, c in Counter(ws).items()}
    size = lambda v: math.sqrt(sum(x * x for x in v.values()))
    own, found, whole = words(text), [], False
    for name, template in notices:
        t, need = words(template), set()
        if len(t) <= SHORT:
            need = set(words(name)) & set(t)
        goal = vector(t)
        for k in {min(len(t), len(own)), len(own)} - {0}:
            for at in range(len(own) - k + 1):
                v = vector(own[at:at + k])
                cosine = round(sum(goal.get(w, 0) * x for w, x in v.items()) / size(goal) / size(v), 9)
                if cosine >= threshold and need <= v.keys():
                    found.append((-cosine, -len(t), name))
                    whole = whole or k == len(own)
    best = min(found, default=None)
    return (best[2], -best[0], whole) if best else (None, None, False)


def test_scan_equals_all_windows():
    rng = random.Random(8)
    short = [(name, t) for name, t in T.TEMPLATES if len(t) < 400]
    vocabulary = sorted({w for _, t in short for w in re.findall(r"\w+", t.lower())})
    frequency = {w: rng.randrange(200) for w in vocabulary}
    notices = Notices(short, frequency, 200)
    texts = ["", " \n", "the " * 50]
    for _ in range(60):
        words = []
        for _ in range(rng.randrange(1, 4)):
            words += rng.choices(vocabulary + ["foo", "bar"], k=rng.randrange(12))
            near = re.findall(r"\w+", rng.choice(short)[1])
            for _ in range(rng.randrange(4)):
                near[rng.randrange(len(near))] = rng.choice(["foo", "bar", "the", "license"])
            words += near
        texts.append(rng.choice([" ", "\n", "\n# "]).join(words))
    for text in texts:
        got, want = notices.scan(text, SIMILARITY), brute(short, frequency, 200, text, SIMILARITY)
        assert got[0] == want[0] and got[2] == want[2], text
        assert (got[1] is None) == (want[1] is None) and abs((got[1] or 0) - (want[1] or 0)) < 1e-8


def test_inheritance_equals_a_walk_up(spark):
    rng = random.Random(4)
    rows, grants = [], ["Released under the MIT License.", "Licensed under CC BY 4.0.", "nothing here"]
    for n in range(150):
        path = "/".join([rng.choice("abc") for _ in range(rng.randrange(5))] + [rng.choice(["LICENSE", f"f{n}"])])
        rows.append((n, path, rng.choice(grants) if path.endswith("LICENSE") else None))
    named = {}
    for n, path, text in sorted(rows, key=lambda r: r[1]):
        if path.rsplit("/", 1)[-1] == "LICENSE" and text != "nothing here":
            named.setdefault(path.rpartition("/")[0], set()).add("MIT" if "MIT" in text else "CC-BY-4.0")
    for r in licenses(files_of(spark, rows)).collect():
        at, want = r.path.rpartition("/")[0], None
        while want is None and at is not None:
            want, at = named.get(at), at.rpartition("/")[0] if at else None
        if r.origin != "own":
            assert (r.license in want) if want else r.license is None
