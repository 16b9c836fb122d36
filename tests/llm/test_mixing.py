import hashlib
import math

from playtrail.llm.mixing import mix

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def brute(rows, weights=(1, 2, 3), cap=3):
    size = [len((t or "").encode().split()) for _, t, *_ in rows]
    names = sorted({r[3] for r in rows if r[3] is not None}, key=lambda s: s.encode()) + [None] * any(r[3] is None for r in rows)
    total = {s: sum(n for n, r in zip(size, rows) if r[3] == s) for s in names}
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    held = set()
    while True:
        rest = sum(total.values()) - sum(cap * total[s] for s in held)
        free = sum(weight[s] for s in names if s not in held)
        share = {s: cap * total[s] if s in held else rest * weight[s] / free for s in names}
        above = {s for s in names if share[s] > cap * total[s]}
        if not above:
            break
        held |= above
    out = []
    for s in names:
        mine = sorted((hashlib.md5(f"mix:{'' if r[0] is None else r[0]}".encode()).hexdigest(), n, r[0]) for n, r in zip(size, rows) if r[3] == s)
        budget, before = math.floor(share[s]), 0
        for _, n, key in mine:
            q = budget // total[s] if total[s] else 0
            out.append((key, n, total[s], round(float(share[s]), 6), q * n + max(0, min(n, budget - q * total[s] - before))))
            before += n
    return sorted(out, key=str)


def got(df):
    return sorted(((r.doc_id, r.size, r.source_size, round(r.target, 6), r.taken) for r in df.collect()), key=str)


def test_same_as_brute_force(spark, frame):
    rows = [(i, "w " * (1 + i * 7 % 23), "en", f"s{min(i % 9, i % 4)}", 1) for i in range(400)]
    rows += [(1000 + i, "a b c d\x0be", "en", "tiny", 1) for i in range(3)]  # only six characters part words
    rows += [(2000, "x", "en", None, 1), (2001, None, "en", "s1", None), (None, "null key", "en", "s1", 1), (2002, "  \n", "en", "void", 1)]
    rows += [(5, "w w", "en", "s1", 1)] * 3  # repeated rows
    df = frame(rows, SCHEMA)
    result = mix(df)
    assert got(result) == brute(rows) == got(mix(df.repartition(7)))
    assert all(r.taken <= 3 * r.size for r in result.collect())


def test_edges(spark, frame):
    df = frame([(1, "a b", "en", "s", 3)], SCHEMA)
    assert mix(df.limit(0)).count() == 0
    assert got(mix(df)) == [(1, 2, 2, 2.0, 2)]
    assert got(mix(frame([(1, "", "en", "s", 3), (2, None, "en", None, 3)], SCHEMA))) == [(1, 0, 0, 0.0, 0), (2, 0, 0, 0.0, 0)]
    wide = mix(df.selectExpr("*", "'mine' as Size", "1 as target", "7 as other"))
    assert wide.columns == ["doc_id", "text", "lang", "source", "n_chars", "other", "size", "source_size", "target", "taken"]


def test_reruns_agree_where_keys_and_sizes_do(spark, frame):
    rows = [(1, f"{t} w", "en", s, 1) for s in ("a", "b", "c") for t in "pqrstuvwxyz"]
    df = frame(rows, SCHEMA)
    runs = [sorted(((r.doc_id, r.source, r.text, r.taken) for r in mix(df.repartition(n)).collect()), key=str) for n in (1, 3, 8)]
    assert runs[0] == runs[1] == runs[2] and any(t % 2 for *_, t in runs[0])


def test_columns_of_any_name(spark, frame):
    df = frame([(1, "a b", "en", "s", 3), (2, "a b c", "en", "t", 3)], SCHEMA)
    names = ["_grp", "_hash", "_range", "_before", "_offset", "_text", "c0", "c1", "_part", "_n"]
    out = mix(df.selectExpr("*", *[f"{n} as {c}" for n, c in enumerate(names)]))
    assert all([r[c] for c in names] == list(range(len(names))) for r in out.collect()) and got(out) == got(mix(df))
