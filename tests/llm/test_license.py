"""Operator 2: against all windows of all templates, without pruning."""

import random
from collections import Counter

import pytest

from ledgerline.llm import license as L

SCHEMA = "doc_id long, text string, license string, Dice double"


def brute(text, templates, threshold):
    words, out = L.words_of(text), []
    for name, template in templates.items():
        t = L.words_of(template)
        span = min(len(t), len(words))
        best = (0.0, 0)
        for i in range(len(words) - span + 1):
            w = words[i:i + span]
            a, b = Counter(zip(w, w[1:], strict=False)), Counter(zip(t, t[1:], strict=False))
            if a and (d := 2 * sum((a & b).values()) / (len(w) + len(t) - 2)) > best[0]:
                best = (d, i)
        if best[0] >= threshold:
            out.append((name, round(best[0], 12), best[1], span))
    return sorted(out)


def noisy(rnd, text, share):
    return " ".join(rnd.choice(["the", "software", "x"]) if rnd.random() < share else w for w in text.split())


@pytest.mark.parametrize("seed", range(6))
def test_scan_equals_brute_force(seed):
    rnd = random.Random(seed)
    scanner = L.Scanner(L.TEMPLATES, L.THRESHOLD)
    for _ in range(6):
        name = rnd.choice(list(L.TEMPLATES))
        text = " ".join([*rnd.choices(["Lorem", "the", "License", "of", "été"], k=rnd.randint(0, 60)),
                         noisy(rnd, L.TEMPLATES[name], rnd.choice([0, 0.02, 0.1, 0.3])),
                         *rnd.choices(["under", "the", "MIT", "rights", "reserved"], k=rnd.randint(0, 30))])
        got = sorted((n, round(d, 12), at, k) for n, d, at, k, _ in scanner.scan(text))
        assert got == brute(text, L.TEMPLATES, L.THRESHOLD)


def test_notices_in_documents(spark):
    rows = [(1, "Some prose.\nReleased under the MIT License."), (2, "RELEASED  under the\nmit license!"), (3, "the license of mit"), (4, None),
            (5, ""), (6, "word"), (7, "prose " * 50_000 + L.TEMPLATES["ISC"]), (2, "RELEASED  under the\nmit license!"), (None, "All rights reserved.")]
    df = spark.createDataFrame([(i, t, "x", 0.1) for i, t in rows], SCHEMA)
    got = L.scan(df).collect()
    assert sorted((str(r["doc_id"]), r["license"]) for r in got) == [
        ("1", "MIT-notice"), ("2", "MIT-notice"), ("2", "MIT-notice"), ("7", "ISC"), ("None", "All-rights-reserved")]
    assert next(r for r in got if r["doc_id"] == 7)["first_word"] == 50_000
    assert next(r for r in got if r["doc_id"] == 1)["matched"] == "released under the mit license"
    assert L.scan(df.where("false")).count() == 0


def test_own_templates(spark):
    df = spark.createDataFrame([(1, "a b c d e f")], "doc_id long, text string")
    assert [r["dice"] for r in L.scan(df, {"t": "b c x e f"}, 0.5).collect()] == [0.5]
    with pytest.raises(ValueError):
        L.Scanner({"t": "one"}, 0.8)


FULL = L.Scanner(L.all_templates(), L.THRESHOLD)


def names(text):
    return [r[0] for r in FULL.report(text)]


@pytest.mark.parametrize(("text", "want"), [
    ("Licensed under the MIT License", ["MIT-notice"]), ("This project is released under the terms of the MIT license.", ["MIT-notice"]),
    ("Licensed under CC BY-SA 4.0", ["CC-BY-SA-4.0-notice"]), ("Text available under CC BY 4.0.", ["CC-BY-4.0-notice"]),
    ("licensed under a Creative Commons Attribution-ShareAlike 3.0 Unported License", ["CC-BY-SA-3.0-notice"]),
    ("This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.", ["CC-BY-SA-4.0-notice"]),
    ("Distributed under the GNU Lesser General Public License, version 2.1", ["LGPL-2.1-notice"]),
    ("Released under the GNU General Public License.", ["GPL-notice"]), ("Licensed under the GPLv2", ["GPL-2.0-notice"]),
    ("Released under the Mozilla Public License 2.0.", ["MPL-2.0-notice"]), ("no licence under the sun", []),
    ("Released under the terms of the agreement.", []), ("Available under the terms of the Eclipse Public License, version 2.0", ["EPL-2.0-notice"]),
    ("Distributed under the terms of the Mozilla Public License.", ["MPL-notice"]),
    ("Licensed under the Apache License 2.0. Docs: licensed under CC BY 4.0.", ["Apache-2.0-notice", "CC-BY-4.0-notice"]),
    *[(L.TEMPLATES[k], [k]) for k in ("GPL-2.0", "GPL-3.0", "LGPL-2.1", "LGPL-3.0", "AGPL-3.0")]])
def test_wordings_and_headers(text, want):
    assert names(text) == want


@pytest.mark.parametrize("file", sorted(L.LICENSES.glob("*.txt")), ids=lambda f: f.stem)
def test_full_texts(file):
    rnd = random.Random(file.stem)
    text = "prose before " * 20 + noisy(rnd, file.read_text(), 0.02) + " prose after" * 20
    long = [x for x in names(text) if x.endswith("-text")]
    assert long == [f"{file.stem}-text"]


def test_worse_of_a_family_elsewhere():
    a, g = L.TEMPLATES["AGPL-3.0"], noisy(random.Random(3), L.TEMPLATES["GPL-3.0"], 0.03)
    got = {r[0]: r[2] for r in FULL.report(f"{a} and {'so ' * 100} {g}")}
    assert got.keys() == {"AGPL-3.0", "GPL-3.0"} and got["GPL-3.0"] >= 180


def test_scan_of_wordings_equals_brute_force():
    some = dict(list(L.all_templates().items())[::23])
    some = {k: v for k, v in some.items() if len(v) < 2000}
    scanner, rnd = L.Scanner(some, L.THRESHOLD), random.Random(5)
    for _ in range(8):
        text = " ".join(noisy(rnd, rnd.choice(list(some.values())), rnd.choice([0, 0.1])) for _ in range(4))
        assert sorted((n, round(d, 12), at, k) for n, d, at, k, _ in scanner.scan(text)) == brute(text, some, L.THRESHOLD)
