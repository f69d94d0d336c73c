import hashlib
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from tessera.llm import repeats
from tessera.components import connected_components
from tessera.llm.lines import dedup_lines
from tessera.llm.repeats import longest_previous_factor, remove_repeats, repeated_windows, suffix_array
from tessera.llm.shingles import jaccard_join, overlap_bound, prefix_length
from tests.llm import corpus


def classes(links, ids):
    up = {i: i for i in ids}

    def find(i):
        while up[i] != i:
            i = up[i]
        return i

    for a, b in links:
        a, b = sorted((find(a), find(b)))
        up[b] = a
    return {i: find(i) for i in ids}


def test_components(spark):
    links = [(i, i + 1) for i in range(0, 60)] + [(100, 200), (200, 150), (7, 7), (300, 301), (301, 300), (None, 4)]
    got = {r.id: r.component for r in connected_components(spark.createDataFrame(links, "a long, b long")).collect()}
    want = classes([(a, b) for a, b in links if a is not None], {x for p in links for x in p if x is not None})
    assert got == {i: c for i, c in want.items() if i != 7 or c != 7}


def shingles(text, width):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate({i: i + 32 for i in range(65, 91)}))
    return frozenset(zip(*(w[i:] for i in range(width)), strict=False)) if len(w) >= width else frozenset([tuple(w)] if w else [])


@pytest.mark.parametrize(("percent", "width", "longest"), [(85, 4, 32), (80, 5, 2), (60, 2, 2), (100, 1, 32)])
def test_jaccard_join_equals_brute_force(spark, percent, width, longest):
    rows = corpus.rows(64)
    out = jaccard_join(corpus.crowded(corpus.table(spark, 64)), percent=percent, width=width, longest_list=longest, heavy_share=4).collect()
    sets = {i: shingles(t, width) for i, t, *_ in rows if i is not None}
    links = [(a, b) for a in sets for b in sets if a < b and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])]
    want = classes(links, sets)
    assert len(out) == len(rows)
    for r in out:
        assert (r.component_id, r.n_shingles) == ((want[r.id], len(sets[r.id])) if r.id is not None else (None, 4 if width > 4 else r.n_shingles)) or r.id is None


def test_jaccard_join_of_nothing(spark):
    assert jaccard_join(corpus.empty(spark)).count() == 0


def test_prefixes_and_bounds():
    assert [prefix_length(n, 85) for n in (1, 2, 20, 100)] == [1, 1, 4, 16]
    a, b = np.array([3, 2, 1, 4], np.uint8), np.array([5, 5], np.uint8)
    assert overlap_bound(a, b) == 10


def windows(rows, length):
    seen, first = Counter(), {}
    texts = {i: (t or "").encode() for i, t, *_ in rows if i is not None}
    for i in sorted(texts):
        for s in range(len(texts[i]) - length + 1):
            w = texts[i][s : s + length]
            seen[w] += 1
            first.setdefault(w, (i, s))
    return texts, seen, first


@pytest.mark.parametrize("share", [1000, 1])
def test_repeats_equal_brute_force(spark, share, monkeypatch):
    """share 1 sends anchors through the path of heavy ones."""
    length = 60
    rows = [r for r in corpus.rows() if r[0] is not None]
    rows = [r for i, r in enumerate(rows) if r[0] not in {x[0] for x in rows[:i]}]
    docs = corpus.crowded(spark.createDataFrame(rows, corpus.SCHEMA))
    texts, seen, first = windows(rows, length)
    if share == 1:
        keep = repeats.repeated_windows
        monkeypatch.setattr(repeats, "repeated_windows", lambda *a, **k: keep(*a, **k, heavy_share=10**9))
        monkeypatch.setattr(repeats, "HEAVY_LEAST", (1, 1))
    for keep_first in (False, True):
        out = remove_repeats(docs, length=length, k=24, keep_first=keep_first, whole_characters=False).collect()
        assert len(out) == len(rows)
        for r in out:
            b = texts[r.id]
            gone = np.zeros(len(b), bool)
            for s in range(len(b) - length + 1):
                w = b[s : s + length]
                if first[w] != (r.id, s) if keep_first else seen[w] > 1:
                    gone[s : s + length] = True
            kept = np.frombuffer(b, np.uint8)[~gone].tobytes()
            assert (r.n_bytes, r.n_removed, r.kept_sha256, r.kept) == (len(b), int(gone.sum()), hashlib.sha256(kept).hexdigest(), kept)
            assert sum(s.end - s.start for s in r.spans) == r.n_removed


def test_repeats_odd_rows(spark):
    rows = [(None, "a" * 300), (1, None), (2, ""), (3, "ä" * 300), (3, "ä" * 300)]
    out = remove_repeats(spark.createDataFrame(rows, "doc_id long, text string"), length=61, k=20).collect()
    assert len(out) == 5
    by = defaultdict(list)
    for r in out:
        by[r.id].append(r)
    assert by[None][0].n_removed == 0 and by[1][0].n_bytes == by[2][0].n_bytes == 0
    assert by[3][0].n_removed == by[3][1].n_removed > 0
    assert all(r.kept.decode() == "ä" * (len(r.kept) // 2) for r in by[3])
    assert remove_repeats(spark.createDataFrame([], "doc_id long, text string")).count() == 0
    with pytest.raises(ValueError):
        repeated_windows(spark.createDataFrame([], "id long, text string"), length=10, k=64)


def test_slices_of_a_long_text_have_its_anchors():
    rng = np.random.default_rng(3)
    data = np.concatenate([rng.integers(97, 123, 9000), np.full(3000, 120), np.tile(rng.integers(97, 123, 70), 60), rng.integers(97, 100, 4000)]).astype(np.uint8)
    off, ids = np.array([0, len(data)]), np.array([5])
    whole = repeats.anchors(data, off, ids, 200, 64)
    for size in (700, 1001, 5000, len(data)):
        assert np.array_equal(np.concatenate(list(repeats.sliced_anchors(data, off, ids, 200, 64, size))), whole)


def test_repeats_of_texts_over_16_mib(spark):
    rng = np.random.default_rng(4)
    noise = rng.integers(97, 123, (1 << 24) + 700_000).astype(np.uint8).tobytes().decode()
    passage, at = noise[1000:1500], (1 << 24) + 300_000
    rows = [(1, noise[:at] + passage + noise[at:]), (2, "x" * ((1 << 24) + 5)), (3, "say " + noise[at + 1000 : at + 1400]), (4, "nothing here")]
    for keep_first in (True, False):
        out = {r.id: r for r in remove_repeats(spark.createDataFrame(rows, "doc_id long, text string"), keep_first=keep_first, with_text=False).collect()}
        spans = {i: [(s.start, s.end) for s in r.spans] for i, r in out.items()}
        first, last = ([], []) if keep_first else ([(1000, 1500)], [(at + 1500, at + 1900)])
        assert spans[3] == [(4, 404)] and spans[4] == [] and spans[2] == [(int(keep_first), (1 << 24) + 5)]
        assert spans[1] == first + [(at, at + 500)] + last


def test_longest_previous_factor_by_suffix_order():
    data = b"abracadabra abracadabra"
    n = len(data)
    assert suffix_array(data).tolist() == sorted(range(n), key=lambda i: data[i:])
    want = [max((k for j in range(i) for k in range(n - i + 1) if data[j : j + k] == data[i : i + k]), default=0) for i in range(n)]
    assert longest_previous_factor(data).tolist() == want


def within(a: bytes, b: bytes, k: int) -> bool:
    if abs(len(a) - len(b)) > k:
        return False
    prev = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        cur = [i]
        for j, y in enumerate(b, 1):
            cur.append(min(prev[j] + 1, cur[-1] + 1, prev[j - 1] + (x != y)))
        prev = cur
    return prev[-1] <= k


@pytest.mark.parametrize("threshold", [1, 2])
def test_line_dedup_equals_brute_force(spark, threshold):
    line = "The quick brown fox jumps over the lazy dog, twice."
    near = [line.replace("quick", "quikc"), line.replace("x j", "xj"), line + "!!", line + "!!!", line[1:], line.replace("dog", "cat"), line.replace("The", "The é")]
    rows = [(5, line + "\n" + near[0]), (1, near[1] + "\n\nshort\n" + near[2]), (2, "short\n" + near[3] + "\n  \n" + near[4]), (3, near[5] + "\n" + line), (9, near[6]), (4, None), (6, ""), (7, "\n"), (None, line), (9, near[6])]
    out = dedup_lines(spark.createDataFrame(rows, "doc_id long, text string").selectExpr("doc_id", "text", "1 as line", "2 as h", "3 as key"), threshold=threshold)
    first = {}
    for i, t in sorted((i, t) for i, t in set(rows) if i is not None and t):
        for n, x in enumerate(t.split("\n")):
            if x.strip(" "):
                first.setdefault(x, (i, n))
    gone = {x for x in first for y in first if x != y and min(len(x.encode()), len(y.encode())) >= 40 and first[y] < first[x] and within(x.encode(), y.encode(), threshold)}
    got = out.collect()
    assert len(got) == len(rows) and out.columns[:2] == ["doc_id", "text"]
    for r in got:
        lines = dict((k, v) for k, v in rows if k == r.doc_id)[r.doc_id]
        want = [] if lines is None or r.doc_id is None else [n for n, x in enumerate(lines.split("\n")) if x.strip(" ") and (x in gone or first[x] != (r.doc_id, n))]
        assert r.removed == want and r.n_removed == len(want)
        assert r.text == (lines if not want else "\n".join(x for n, x in enumerate(lines.split("\n")) if n not in want))
    assert dedup_lines(corpus.empty(spark)).count() == 0


def test_lines_of_one_id_with_two_texts(spark):
    """Each row keeps its own lines; short lines may differ by one edit from 20 bytes on."""
    rows = [(1, "A\nB"), (1, "C\nA"), (2, "a line of 23 bytes here\nPage 3 of 12"), (3, "a line of 23 bytes hare\nPage 4 of 12\na line of 23 bxxes here")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    out = {r.text for r in dedup_lines(docs, least_bytes=20).collect()}
    texts = {t for _, t in rows}
    first, second = ("A\nB", "C") if "A\nB" in out else ("B", "C\nA")
    assert out == {first, second, rows[2][1], "Page 4 of 12\na line of 23 bxxes here"}
    assert {r.text for r in dedup_lines(docs).collect()} == {first, second} | texts - {rows[0][1], rows[1][1]}


def test_jaccard_join_of_large_and_shared_ids(spark):
    a, b = "one two three four five six", "seven eight nine ten eleven twelve"
    big = 5 * 10**18
    rows = [(1, a), (1, b), (big, a), (big + 1, a), (7, b), (3, "a b c")]
    out = jaccard_join(spark.createDataFrame(rows, "doc_id long, text string"), percent=80, width=4).collect()
    assert sorted((r.id, r.component_id) for r in out) == sorted([(1, 1), (1, 1), (big, 1), (big + 1, 1), (7, 1), (3, 3)])


def test_smaller_neighbours():
    rng = np.random.default_rng(2)
    for x in (rng.integers(0, 9, 50), np.arange(40), np.arange(40)[::-1], np.zeros(5, np.int64), np.zeros(0, np.int64)):
        prev, nxt = repeats.smaller_neighbours(x)
        assert prev.tolist() == [max((j for j in range(i) if x[j] <= x[i]), default=-1) for i in range(len(x))]
        assert nxt.tolist() == [min((j for j in range(i + 1, len(x)) if x[j] <= x[i]), default=len(x)) for i in range(len(x))]
