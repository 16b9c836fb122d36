import random
from collections import Counter, defaultdict

import numpy as np

from playtrail.llm import decontamination as dc
from playtrail.llm.decontamination import overlaps, without_leaks

DOCS, BENCH = "doc_id long, text string, lang string, source string, n_chars long", "item_id long, text string"


def plain(text):
    return [p for w in (text or "").split() if (p := w.strip(dc.STRIP).lower())]


def brute(docs, bench):
    """Every diagonal of every pair, kept when a mask agrees at some position and the stretch there is long enough."""
    found = set()
    for d, text, *_ in docs:
        a = plain(text)
        for i, item in bench:
            b = plain(item)
            if len(b) < dc.SHORTEST:
                continue
            masks = dc.MASKS if len(b) >= len(dc.MASKS[0]) else ("1" * len(b),)
            place = defaultdict(list)
            for q, w in enumerate(b):
                place[w].append(q)
            shifts = Counter(p - q for p, w in enumerate(a) for q in place.get(w, ()))
            for shift in (s for s, n in shifts.items() if n >= dc.SHORTEST):  # no mask has fewer ones
                same = [0 <= p + shift < len(a) and a[p + shift] == b[p] for p in range(len(b))]
                hits = [p for m in masks for p in range(len(b) - len(m) + 1) if 0 <= p + shift and p + shift + len(m) <= len(a) and all(same[p + j] for j, c in enumerate(m) if c == "1")]
                inside = [p for p in range(len(b)) if 0 <= p + shift < len(a)]
                score = lambda r: sum(1 if same[p] else -dc.PENALTY for p in r)
                for at in hits:
                    end = max(range(at + 1, inside[-1] + 2), key=lambda e: (score(range(at, e)), -e))
                    start = max(range(inside[0], at + 1), key=lambda s: (score(range(s, at)), s))
                    n, eq = end - start, sum(same[start:end])
                    if n >= min(dc.LEAST_TOKENS, len(b)) and eq >= dc.LEAST_IDENTITY * n:
                        found.add((d, i))
    return sorted(found, key=str)


def test_same_as_brute_force(spark, frame):
    rng = random.Random(4)
    vocabulary = [f"w{i}" for i in range(60)]
    line = lambda n: [rng.choice(vocabulary) for _ in range(n)]
    bench = [(i, line(rng.choice([3, 5, 7, 12, 13, 15, 30, 59]))) for i in range(25)]
    docs = []
    for d in range(260):
        text = line(rng.randint(0, 120))
        if d % 2:
            part = list(rng.choice(bench)[1])
            part = part[rng.randint(0, len(part) // 3):]
            for _ in range(rng.randint(0, 3)):
                part[rng.randrange(len(part))] = rng.choice(vocabulary)
            text = text[:20] + [w + rng.choice(["", ".", ","]) for w in part] + text[20:]
        docs.append((d, " ".join(w.upper() if rng.random() < 0.1 else w for w in text), "en", "s", 1))
    bench = [(i, " ".join(b)) for i, b in bench]
    got = overlaps(frame(docs, DOCS).repartition(3), frame(bench, BENCH)).collect()
    want = brute(docs, bench)
    assert len(want) > 40 and sorted(((r.doc_id, r.item_id) for r in got), key=str) == want


def test_edges(spark, frame):
    item = " ".join(f"t{i}" for i in range(20))
    changed = item.replace("t4 ", "x ").replace("t11 ", "y ")
    docs = [(1, "before " + item + " after", "en", "s", 1), (1, "clean text with the same id", "en", "s", 1), (2, None, "en", None, 1), (3, "", "en", "s", 1),
            (4, changed, "en", "s", 1), (5, "t1 t2 t3 t4 t5 t6 t7", "en", "s", 1), (None, item, "en", "s", 1), (6, "a b c d e", "en", "s", 1),
            (7, "pad " * 50_000 + item, "en", "s", 1), (1, "before " + item + " after", "en", "s", 1)]
    bench = [(10, item), (11, "a b"), (12, None), (13, ""), (14, "a b c d e"), (15, item), (None, item)]
    df, items = frame(docs, DOCS), frame(bench, BENCH)
    rows = overlaps(df, items).where("item_id in (10, 14)").collect()
    assert sorted((str(r.doc_id), r.item_id, r.start, r.n_tokens, r.n_same) for r in rows) == [
        ("1", 10, 1, 20, 20), ("4", 10, 0, 20, 18), ("6", 14, 0, 5, 5), ("7", 10, 50_000, 20, 20), ("None", 10, 0, 20, 20)]
    assert overlaps(df, items).where("item_id = 15").count() == 4
    clean = without_leaks(df, items)
    assert clean.columns == df.columns and sorted(r.doc_id for r in clean.collect()) == [1, 2, 3, 5]
    assert without_leaks(df, items.limit(0)).count() == len(docs) and without_leaks(df.limit(0), items).count() == 0
    wide = df.selectExpr("*", "1 as item_id", "2 as content", "3 as start", "4 as _content", "5 as segment", "6 as leak", "7 as c0")
    kept = without_leaks(wide, items)
    assert kept.columns == wide.columns and {tuple(r)[5:] for r in kept.collect()} == {(1, 2, 3, 4, 5, 6, 7)} and kept.count() == 4


def test_items_without_id_count(spark, frame):
    first, second = " ".join(f"t{i}" for i in range(20)), " ".join(f"u{i}" for i in range(20))
    df, items = frame([(1, first + " x " + second, "en", "s", 1), (2, "clean", "en", "s", 1)], DOCS), frame([(None, first), (None, second)], BENCH)
    assert sorted((r.doc_id, r.item_id, r.start, r.n_tokens) for r in overlaps(df, items).collect()) == [(1, None, 0, 20), (1, None, 21, 20)]
    assert [r.doc_id for r in without_leaks(df, items).collect()] == [2]


def test_a_seed_survives_changes_under_its_zeros():
    code = np.arange(1, 14, dtype=np.uint64)
    for number, mask in enumerate(dc.MASKS):
        other = code.copy()
        other[[i for i, c in enumerate(mask) if c == "0"]] = 99
        assert dc.seeds(code, mask, number)[0] == dc.seeds(other, mask, number)[0]


def maskless(docs, bench):
    """Every agreeing token of every diagonal of every pair, whatever the masks."""
    found = set()
    for d, text, *_ in docs:
        a = plain(text)
        for i, item in bench:
            b = plain(item)
            for shift in range(-len(b) + 1, len(a)):
                places = range(max(0, -shift), min(len(b), len(a) - shift))
                same = [a[p + shift] == b[p] for p in places]
                if len(b) < dc.SHORTEST or sum(same) < dc.SHORTEST:
                    continue
                gain = [1 if s else -dc.PENALTY for s in same]
                for at in (p for p, s in enumerate(same) if s):
                    end = max(range(at + 1, len(same) + 1), key=lambda e: (sum(gain[at:e]), -e))
                    start = max(range(at + 1), key=lambda s: (sum(gain[s:at]), s))
                    n, eq = end - start, sum(same[start:end])
                    if n >= min(dc.LEAST_TOKENS, len(b)) and eq >= max(dc.SHORTEST, dc.LEAST_IDENTITY * n):
                        found.add((d, i))
    return sorted(found)


def test_changed_words_hide_no_item_whatever_the_masks(spark, frame):
    rng = random.Random(9)
    bench = [(n, [f"i{n}t{j}" for j in range(n)]) for n in (5, 6, 7, 8, 9, 10, 11, 12, 13, 15, 20, 25, 40)]
    docs = []
    for n, item in bench:
        for _ in range(30):
            part = list(item)
            if n > 20 and rng.random() < 0.5:  # a piece of a long item
                at = rng.randrange(n - 12)
                part = part[at:at + 12]
            for at in rng.sample(range(len(part)), rng.randint(0, len(part) // 4)):
                part[at] = "changed"
            docs.append((len(docs), " ".join(["before"] * 7 + part + ["after"] * 5), "en", "s", 1))
    bench = [(i, " ".join(b)) for i, b in bench]
    got = overlaps(frame(docs, DOCS), frame(bench, BENCH)).collect()
    want = maskless(docs, bench)
    assert {i for _, i in want} == {i for i, _ in bench}
    assert sorted((r.doc_id, r.item_id) for r in got) == want
    assert sum("changed" in docs[d][1] and i < 13 for d, i in want) > 40


def test_no_stretch_avoids_every_hashed_mask():
    for n in range(dc.SHORTEST, 19):
        inner = np.arange(1 << (n - 2))
        same = ((((inner << 1) | 1 | (1 << (n - 1)))[:, None] >> np.arange(n)) & 1).astype(bool)
        same = same[same.sum(axis=1) >= max(dc.SHORTEST, dc.LEAST_IDENTITY * n)]
        hit = np.zeros(len(same), dtype=bool)
        for mask in dc.HASHED:
            ones = [j for j, c in enumerate(mask) if c == "1"]
            for at in range(n - len(mask) + 1):
                hit |= same[:, [at + j for j in ones]].all(axis=1)
        assert not [s for s in same[~hit] if any(dc.stretch(s, at) == (0, n) for at in np.flatnonzero(s))]


def test_a_rejected_stretch_hides_no_verbatim_part(spark, frame):
    item = [f"t{i}" for i in range(150)]
    docs = [(1, " ".join(item[:20] + ["new"] * 40 + item[60:]), "en", "s", 1), (2, " ".join(item[:90] + ["new"] * 40 + item[130:]), "en", "s", 1)]
    four = [f"f{i}" for i in range(116)]  # each of the runs leads to the whole, which is 0.741 alike
    docs.append((3, " ".join(w if not 22 <= i < 32 and not 53 <= i < 63 and not 84 <= i < 94 else "new" for i, w in enumerate(four)), "en", "s", 1))
    rows = overlaps(frame(docs, DOCS), frame([(10, " ".join(item)), (11, " ".join(four))], BENCH)).collect()
    assert sorted((r.doc_id, r.item_id, r.start, r.n_tokens, r.n_same) for r in rows) == [(1, 10, 60, 90, 90), (2, 10, 0, 90, 90), (3, 11, 32, 84, 64)]
