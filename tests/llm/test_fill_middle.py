import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from ferry.llm import fill_middle as fim
from tests.llm.cases import AWKWARD, LONG, awkward, clashing, docs, empty, rows

COLUMNS = "doc_id n form prefix_chars middle_chars output_sha256 restored_sha256".split()


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def expected(key, text, seed=7, rewritten=100, suffix_first=50):
    text = text or ""
    lines = re.findall(r"[^\n]*\n|[^\n]+", text)
    digest = sha(f"{seed}:{'' if key is None else key}")
    h = [int(digest[8 * i : 8 * i + 8], 16) for i in range(4)]
    n = len(lines)
    low, high = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    p, m, s = ("".join(x) for x in (lines[:low], lines[low:high], lines[high:]))
    if not text or any(mark in text for mark in ("<P>", "<S>", "<M>")) or h[2] % 100 >= rewritten:
        return (key, n, "plain", None, None, sha(text), sha(text))
    spm = h[3] % 100 < suffix_first
    out = f"<S>{s}<P>{p}<M>{m}" if spm else f"<P>{p}<S>{s}<M>{m}"
    return (key, n, "spm" if spm else "psm", len(p), len(m), sha(out), sha(text))


def in_order(found):
    return sorted(found, key=lambda r: [(v is not None, v) for v in r])


def lines(seed, n):
    draw = random.Random(seed)
    return "\n".join("".join(draw.choice("abc日é \r<>PSM") for _ in range(draw.randrange(80))) for _ in range(n))


TEXTS = ["\n", "\n\n", "a", "a\n", "\na", "a<P>b\nc", "<S>", "x<M", "<P\n<S\n<M\n", "日\n本\n語", "no end\r\nof\r\nline", LONG]


def test_digests_equal_brute_force(spark):
    given = list(enumerate(TEXTS)) + [(100 + i, lines(i, i * 4)) for i in range(120)]
    assert rows(fim.digests(docs(spark, given)), *COLUMNS) == in_order(expected(*r) for r in given)
    forms = [r[2] for r in rows(fim.digests(docs(spark, given)), *COLUMNS)]
    assert {"plain", "spm", "psm"} == set(forms)


@pytest.mark.parametrize("options", [{"seed": 1, "rewritten": 50, "suffix_first": 0}, {"rewritten": 0}, {"suffix_first": 100}])
def test_options(spark, options):
    given = [(i, lines(i, 9)) for i in range(60)]
    assert rows(fim.digests(docs(spark, given), **options), *COLUMNS) == in_order(expected(*r, **options) for r in given)


def test_awkward_clashing_and_empty_tables(spark):
    want = in_order(expected(*r[:2]) for r in AWKWARD)
    assert rows(fim.digests(awkward(spark)), *COLUMNS) == want
    taken = clashing(spark).withColumn("n", F.lit("n")).withColumn("OUTPUT", F.lit("o")).withColumn("_cuts", F.lit(1))
    assert rows(fim.digests(taken), *COLUMNS) == want
    made = fim.rewrite(taken)
    assert made.columns[: len(taken.columns)] == taken.columns
    back = made.select("text", fim.restore("output_", "form").alias("back"))
    assert back.where("coalesce(text, '') <> back").count() == 0 and back.count() == len(AWKWARD)
    assert fim.digests(empty(spark)).collect() == []


@pytest.mark.parametrize("size", [0, 1, 31, 32, 33, 64, 5000, fim.HASHED - 1, fim.HASHED, fim.HASHED + 1, 3 * fim.HASHED + 17])
def test_chunks_cover_the_text(size):
    data = random.Random(size).randbytes(size)
    ends = [0, *fim.chunk_ends(data)]
    sizes = [b - a for a, b in zip(ends, ends[1:])]
    assert ends[-1] == size and all(0 < s <= fim.MOST_CHUNK for s in sizes)
    assert all(s >= fim.LEAST_CHUNK for s in sizes[:-1])


def test_chunk_ends_do_not_depend_on_how_much_is_hashed_at_a_time(monkeypatch):
    data = random.Random(1).randbytes(50_000)
    ends = fim.chunk_ends(data)
    monkeypatch.setattr(fim, "HASHED", 1000)
    assert fim.chunk_ends(data) == ends
    assert 100 < 50_000 / len(ends) < 600
    assert len(fim.chunk_ends(b"\0" * 100_000)) < 2000


def test_shared_passages_are_counted_once():
    passage = random.Random(2).randbytes(20_000).replace(b"\r", b"\n")
    summaries = fim.Summaries()
    fim.Lines(random.Random(3).randbytes(3000) + passage, summaries)
    before = summaries.made
    fim.Lines(random.Random(4).randbytes(777) + passage, summaries)
    assert summaries.made - before < before / 3


def test_summaries_forget_but_stay_right():
    summaries = fim.Summaries(most=4000)
    for i in range(30):
        text = lines(i % 5, 60)
        data = text.encode()
        found = fim.Lines(data, summaries)
        parts = re.findall(r"[^\n]*\n|[^\n]+", text)
        assert found.count == len(parts)
        assert [found.points_of(k) for k in range(len(parts) + 1)] == [len("".join(parts[:k])) for k in range(len(parts) + 1)]
        assert sum(map(len, (*summaries.young, *summaries.old))) <= 4000 + 2 * fim.MOST_CHUNK
