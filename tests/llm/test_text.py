import random
import re

import pytest

from ferry.llm import decontaminate, licenses, line_dedup
from ferry.llm.decontaminate import MASKS, MISSES, WINDOW
from tests.llm.cases import AWKWARD, awkward, clashing, docs, empty, rows

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def _words(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


TEXTS = [
    "Licensed under CC-BY. All rights  reserved; ALL RIGHTS RESERVED!",
    "cc cc by by cc by",
    "the general public license general public license",
    "GNU General Public License, version 2",
    "Licensed under the Apache License, Version 2.0.",
    "apache licence version 2 0",
    "all rights are reserved",
    "Released under the MIT License",
    "cc\0by É all rights reserved",
    "general public",
    *[r[1] for r in AWKWARD],
]


def _base(words):
    found = []
    for label, phrase in (("cc-by", "cc by"), ("gpl", "general public license"), ("reserved", "all rights reserved")):
        p = phrase.split()
        found += [(i, label) for i in range(len(words)) if words[i : i + len(p)] == p]
    return found


def test_base_phrases_equal_brute_force(spark):
    got = licenses.scan(docs(spark, list(enumerate(TEXTS)))).collect()
    assert len(got) == len(TEXTS)
    for r in got:
        words = _words(TEXTS[r.doc_id])
        found = _base(words)
        assert (r.n_words, r.n_base) == (len(words), len(found))
        assert r.base_labels == ",".join(sorted({x for _, x in found}))
        assert (r.first_word, r.last_word) == ((min(found)[0], max(found)[0]) if found else (None, None))
        assert set(filter(None, r.base_labels.split(","))) <= set(filter(None, r.labels.split(",")))
        assert 0 <= r.score <= 1 and (r.score == 1) >= bool(found)


def test_notices_add_labels(spark):
    got = {r.doc_id: r for r in licenses.scan(docs(spark, list(enumerate(TEXTS)))).collect()}
    assert got[3].labels == "gpl,gpl-2.0" and got[4].labels == "apache-2.0" and got[7].labels == "mit"
    assert got[5].labels == "" and got[5].score == 0 and got[6].labels == ""


def test_scan_of_nothing_and_of_clashing_names(spark):
    assert licenses.scan(empty(spark)).count() == 0
    assert licenses.scan(clashing(spark)).count() == len(AWKWARD)


def test_masks_find_every_window_with_two_changes():
    for a in range(WINDOW):
        for b in range(a):
            free = [
                m for m in MASKS for s in range(WINDOW - len(m) + 1)
                if all(m[i] == "0" or s + i not in (a, b) for i in range(len(m)))
            ]
            assert free, (a, b)


def _overlaps(words, item):
    out = []
    for start in range(-len(item) + 1, len(words)):
        same = [0 <= start + i < len(words) and words[start + i] == w for i, w in enumerate(item)]
        windows = [sum(same[i : i + WINDOW]) for i in range(len(item) - WINDOW + 1)]
        short = len(item) < WINDOW and sum(same) >= len(item) - (len(item) >= 5)
        if (windows and max(windows) >= WINDOW - MISSES) or short:
            out.append(start)
    return out


def _planted():
    draw = random.Random(5)
    vocabulary = [f"w{i}" for i in range(60)]
    text = lambda n: [draw.choice(vocabulary) for _ in range(n)]
    items = [text(n) for n in (1, 2, 3, 4, 5, 5, 6, 7, 8, 9, 10, 11, 12, 13, 14, 30, 60)]
    made = []
    for k in range(160):
        item = list(items[k % len(items)])
        for _ in range(draw.choice((0, 1, 2, 3, 6))):
            item[draw.randrange(len(item))] = "changed"
        cut = draw.randrange(0, 4)
        made.append(text(draw.randrange(40)) + item[cut:] + text(draw.randrange(40)))
    return made, items


def test_overlaps_equal_brute_force(spark):
    made, items = _planted()
    df = docs(spark, [(i, " ".join(w)) for i, w in enumerate(made)])
    bench = spark.createDataFrame([(i, ", ".join(w)) for i, w in enumerate(items)], "item_id bigint, text string")
    key = {"doc_id": df.doc_id}
    want = {
        (d, i): found for d, w in enumerate(made) for i, item in enumerate(items) if (found := _overlaps(w, item))
    }
    assert len(want) > 20
    got = decontaminate.overlaps(df, bench, key).collect()
    assert {(r.doc_id, r.item_id): r.alignments for r in got} == {k: len(v) for k, v in want.items()}
    assert all(r.start_word in want[r.doc_id, r.item_id] for r in got)
    assert all(r.phrase == (len(items[r.item_id]) < 5) for r in got)
    changed = {len(items[r.item_id]) for r in got if r.same_words < len(items[r.item_id]) < WINDOW}
    assert len(changed) >= 5
    joined = decontaminate.overlaps(df, bench, key, broadcast_bytes=0)
    assert rows(joined, *joined.columns) == sorted(tuple(r) for r in got)
    no_phrases = bench.where("item_id > 3")
    assert rows(decontaminate.overlaps(df, no_phrases, key), *joined.columns) == sorted(tuple(r) for r in got if r.item_id > 3)


def test_masks_find_every_changed_word_of_short_items():
    for n in range(5, WINDOW):
        for changed in range(n):
            assert [
                m for m in decontaminate.short_masks(n) for s in range(n - len(m) + 1)
                if all(m[i] == "0" or s + i != changed for i in range(len(m)))
            ], (n, changed)


def test_short_items_of_a_question_bank(spark):
    texts = ["what is the capital of france", "what is the capital of spain today", "forty two or forty", "nothing of it"]
    bench = spark.createDataFrame([(1, "What is the capital of France?"), (2, "forty two")], "item_id bigint, text string")
    df = docs(spark, list(enumerate(texts)))
    got = rows(decontaminate.overlaps(df, bench, {"doc_id": df.doc_id}), "doc_id", "item_id", "start_word", "same_words", "phrase")
    assert got == [(0, 1, 0, 6, False), (1, 1, 0, 5, False), (2, 2, 0, 2, True)]
    assert {r.doc_id for r in decontaminate.drop_contaminated(df, bench).collect()} == {2, 3}
    assert {r.doc_id for r in decontaminate.drop_contaminated(df, bench, phrases=True).collect()} == {3}


def test_clean_documents_stay(spark):
    made, items = _planted()
    bench = spark.createDataFrame(
        [*((i, " ".join(w)) for i, w in enumerate(items)), (None, None), (9, "")], "item_id bigint, text string"
    )
    bad = {d for d, w in enumerate(made) if any(_overlaps(w, item) for item in items if len(item) >= 5)}
    df = clashing(spark, [*((i, " ".join(w)) for i, w in enumerate(made)), *((r[0] and 1000 + r[0], r[1]) for r in AWKWARD)])
    kept = decontaminate.drop_contaminated(df, bench)
    assert kept.columns == df.columns
    assert kept.count() == len(made) - len(bad) + len(AWKWARD)
    assert not bad & {r.doc_id for r in kept.select("doc_id").collect()}
    assert decontaminate.drop_contaminated(df, empty(spark, "item_id bigint, text string")).count() == df.count()
    assert decontaminate.drop_contaminated(empty(spark), bench).count() == 0


def _lines():
    made = []
    for site in range(14):
        lines = [f"only here {site}", "", "everywhere"]
        lines += [f"on {n}" + ("\r" if site % 2 else "\t") for n in (8, 9, 10, 11, 12) if site < n]
        made.append((site, "\n".join(lines), None, f"s{site}"))
        made.append((100 + site, "\n".join(["on 9 ", "everywhere", " own"]), None, f"s{site % 3}"))
    return made


@pytest.mark.parametrize("listed", [10_000, 0])
def test_lines_equal_brute_force(spark, monkeypatch, listed):
    """Whether the lines that go are a condition or are looked up."""
    monkeypatch.setattr(line_dedup, "LISTED_LINES", listed)
    made = _lines()
    blanks = " \t\r\x0b\x0c"
    spread = {}
    for _, text, _, site in made:
        for line in text.split("\n"):
            spread.setdefault(line.strip(blanks), set()).add(site)
    bad = {line for line, sites in spread.items() if line and len(sites) >= 10}
    assert bad == {"everywhere", "on 10", "on 11", "on 12"}
    for r in line_dedup.remove_boilerplate(docs(spark, made)).collect():
        lines = dict((m[0], m[1]) for m in made)[r.doc_id].split("\n")
        kept = [x for x in lines if x.strip(blanks) not in bad]
        assert (r.text, r.n_lines, r.n_removed) == ("\n".join(kept), len(lines), len(lines) - len(kept))


def test_lines_of_awkward_rows(spark):
    got = line_dedup.remove_boilerplate(awkward(spark), min_sites=3)
    assert got.count() == len(AWKWARD)
    assert rows(got.where("text is null"), "n_lines", "n_removed") == [(1, 0), (1, 0)]
    one = got.where("doc_id = 2").first()  # on a, b and the null site once blanks inside are the same
    assert one.n_removed == 0
    same = docs(spark, [(1, "x", None, "a"), (2, "x", None, "b"), (3, "x\ny", None, None)])
    assert rows(line_dedup.remove_boilerplate(same, 3), "doc_id", "text") == [(1, ""), (2, ""), (3, "y")]
    assert line_dedup.remove_boilerplate(empty(spark)).count() == 0
    wide = clashing(spark)
    assert set(wide.columns) < set(line_dedup.remove_boilerplate(wide).columns)

