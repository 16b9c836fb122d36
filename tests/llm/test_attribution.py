import random
from collections import defaultdict

import pytest

from playtrail.llm import attribution
from playtrail.llm.attribution import token_counts


def token_bytes(text):
    encode, _ = attribution.encoder(attribution.VOCABULARY, attribution.PATTERN)
    return [encode.decode_single_token_bytes(t) for t in encode.encode_ordinary(text)]


def brute(text, sections):
    """Byte by byte: which section holds it, and to which the token goes."""
    owner = []
    for i, c in enumerate(text):
        mine = next((n for n, (a, b) in enumerate(sections) if a <= i < b), -1)
        owner += [mine] * len(c.encode())
    counts, share, cross, at = defaultdict(int), defaultdict(float), defaultdict(int), 0
    for token in token_bytes(text):
        parts = defaultdict(int)
        for o in owner[at:at + len(token)]:
            parts[o] += 1
        at += len(token)
        inside = [o for o in parts if o >= 0] or [-1]
        counts[max(inside, key=lambda o: (parts[o], -o))] += 1
        for o, n in parts.items():
            share[o] += n / len(token)
            cross[o] += len(parts) > 1
    assert b"".join(token_bytes(text)) == text.encode() and at == len(owner)
    return counts, share, cross


def lines(text):
    out, at = [], 0
    for line in text.splitlines(keepends=True) if "\r" not in text else [text]:
        out.append((at, at + len(line)))
        at += len(line)
    return out or [(0, 0)]


TEXTS = ["", "one line", "Two\nlines here", "\n\n\nblank  \n\n lines\n", "é😀 ünï\n日本語の\n\n\nwörter 123\n", "a" * 500 + "\n" + " " * 300 + "\nb", "x\n" * 50]


def test_lines_against_bytes(spark, frame):
    rows = [(i, t) for i, t in enumerate(TEXTS)]
    got = defaultdict(list)
    for r in token_counts(frame(rows, "doc_id long, text string")).collect():
        got[r.doc_id].append((r.section, r.start, r.stop, r.n_tokens, round(r.share, 9), r.n_crossing))
    for i, text in rows:
        sections = lines(text)
        counts, share, cross = brute(text, sections)
        assert sorted(got[i]) == [(n, a, b, counts[n], round(share[n], 9), cross[n]) for n, (a, b) in enumerate(sections)]
        assert sum(g[3] for g in got[i]) == len(token_bytes(text))


def test_given_sections(spark, frame):
    rng, rows, want = random.Random(1), [], {}
    for i in range(60):
        text = "".join(rng.choice(["word ", "é", "日本", "\n", " ", "longerword", "1", ". "]) for _ in range(rng.randint(0, 30)))
        cuts = sorted(rng.randint(0, len(text)) for _ in range(2 * rng.randint(0, 3)))
        sections = [(a, b) for a, b in zip(cuts[::2], cuts[1::2])]
        rows.append((i, text, [{"start": a, "stop": b, "name": "n"} for a, b in sections][::-1]))
        want[i] = (text, sorted(sections))
    got = defaultdict(dict)
    for r in token_counts(frame(rows, "doc_id long, text string, parts array<struct<start:int,stop:int,name:string>>"), sections="parts").collect():
        got[r.doc_id][r.section] = (r.n_tokens, round(r.share, 9), r.n_crossing)
    for i, (text, sections) in want.items():
        counts, share, cross = brute(text, sections)
        for n, (a, b) in enumerate(sections):
            assert got[i][n] == ((counts[n], round(share[n], 9), cross[n]) if b > a else (0, 0.0, 0))
        assert got[i].get(-1, (0, 0.0, 0)) == (counts[-1], round(share[-1], 9), cross[-1])


def test_edges(spark, frame):
    df = frame([(1, None, 5, None), (1, "", 5, []), (None, "a b", 5, [None, (1, 99), (-4, 2), (0, None)]), (2, "a b", 5, [(2, 1)])],
               "doc_id long, text string, section int, parts array<struct<start:int,stop:int>>")
    plain = sorted((str(r.doc_id), r.section, r.n_tokens) for r in token_counts(df).collect())
    assert plain == [("1", 0, 0), ("1", 0, 0), ("2", 0, 2), ("None", 0, 2)]
    given = sorted((str(r.doc_id), r.section, r.start, r.stop, r.n_tokens) for r in token_counts(df, sections="parts").collect())
    assert given == [("2", -1, 0, 3, 2), ("2", 0, 2, 2, 0), ("None", 0, 0, 0, 0), ("None", 1, 0, 0, 0), ("None", 2, 0, 2, 2), ("None", 3, 2, 3, 0)]
    assert token_counts(df.limit(0)).count() == 0


def test_pattern_is_that_of_the_vocabulary():
    tokenizers = pytest.importorskip("public_tokenizers")
    assert attribution.PATTERN == tokenizers.PATTERN


def test_long_runs_of_blanks(spark, frame):
    encode, _ = attribution.encoder(attribution.VOCABULARY, attribution.PATTERN)
    for run in (" " * 5000, "\n" * 4096, "\u00a0 \t" * 3000, " " * 4095):
        for text in (run, f"a{run}b", f"{run}b", f"a{run}", f"a{run}.{run}'s", f"{run[:-1]} x"):
            assert attribution.ids_of(encode, text) == encode.encode_ordinary(text)
    rows = token_counts(frame([(1, " " * 1_000_000, 0), (2, "a" + " " * 1_000_000 + "b", 0)], "doc_id long, text string, n int")).collect()
    assert {(r.doc_id, r.n_tokens) for r in rows} == {(1, 1_000_000), (2, 1_000_001)}
