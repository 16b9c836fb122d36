import hashlib
import random
import zlib

from hypothesis import given, settings, strategies as st

from playtrail.llm import prefix_trie as T

SCHEMA = "conv_id long, turn long, role string, text string, depth int"


def nodes_of(chats):
    """{conversation: [(role, text)]} to the nodes, with dictionaries of prefixes."""
    members = {}
    for c, turns in chats.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(c)
    out = []
    for path, ids in members.items():
        below = [p for p in members if p[:len(path)] == path]
        children = [p for p in below if len(p) == len(path) + 1]
        ends = ",".join(map(str, sorted(c for c in ids if tuple(chats[c]) == path)))
        out.append((min(ids), len(path), min(members[path[:-1]]) if path else None, len(ids), len(children),
                    sum(not any(len(q) == len(p) + 1 and q[:len(p)] == p for q in below) for p in below),
                    sum((len(members[p]) - 1) * len(p[-1][1]) for p in below if p), hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def plain(rows, rebuild=True):
    own = {}
    for c, turn, role, text, *_ in rows:
        if c is not None:
            role, text = role or "", text or ""
            own.setdefault(c, []).append(((turn is not None, turn or 0), hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).hexdigest(), role, text))
    own = {c: [t[2:] for t in sorted(v)] for c, v in own.items()}
    if not rebuild:
        return own
    h = {c: zlib.crc32(str(c).encode()) % 6 for c in own}
    return {c: own.get(c - c % 100, [])[:h[c]] + own[c][h[c]:] for c in own}


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def chat_rows(seed, convs=260):
    rng = random.Random(seed)
    rows = []
    for c in rng.sample(range(600), convs):
        for t in range(rng.randrange(1, 9)):
            rows.append((c, rng.choice([t, t, None]) if rng.random() < 0.1 else t, rng.choice(["user", None, ""]), rng.choice(["a", "bb", "é😀", "", None]), 0))
    return rows


def test_same_as_brute_force(spark, frame, monkeypatch):
    rows = chat_rows(1) + [(c, t, "user", "copy", 0) for c in range(1000, 1300) for t in range(7)]
    chats = T.regrouped(T.sequences(frame(rows, SCHEMA)))
    expected = nodes_of(plain(rows))
    assert rows_of(T.trie(chats)) == expected
    monkeypatch.setattr(T, "PART_ROWS", 7)  # many partitions: spines through all of them
    monkeypatch.setattr(T, "BLOCK_BITS", 3)
    got = T.trie(chats)
    assert got.columns == ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    assert rows_of(got) == expected


def test_without_regrouping(spark, frame, monkeypatch):
    monkeypatch.setattr(T, "PART_BYTES", 2000)
    rows = chat_rows(2, 120) + [(700, t, "user", str(t % 3), 0) for t in range(900)] + [(701, t, "user", str(t % 3), 0) for t in range(850)]
    assert rows_of(T.trie(T.sequences(frame(rows, SCHEMA)))) == nodes_of(plain(rows, False))


def test_edges(spark, frame):
    rows = [(None, 0, "user", "lost", 0), (5, None, None, None, 0), (5, None, None, None, 0), (100, 1, "user", "x", 0), (100, 1, "a", "y", 0), (101, 0, "user", "z", 0), (-3, 0, "u", "v", 0)]
    df = frame(rows, SCHEMA)
    assert rows_of(T.trie(T.sequences(df))) == nodes_of(plain(rows, False))
    assert T.trie(T.regrouped(T.sequences(df.limit(0)))).count() == 0
    wide = df.selectExpr("*", "1 as c", "2 as e", "3 as path", "4 as part")
    assert rows_of(T.trie(T.sequences(wide))) == rows_of(T.trie(T.sequences(df)))


@settings(max_examples=200, deadline=None)
@given(st.lists(st.lists(st.sampled_from("ab"), max_size=5).map(tuple), min_size=1, max_size=12), st.lists(st.integers(0, 11), max_size=3))
def test_forests_add_up(chats, cuts):
    """Any cut into partitions gives the nodes of the whole, spine nodes added up."""
    def entry(turn):
        return hashlib.sha256(turn.encode()).digest()[:16] + len(turn).to_bytes(8)
    given_chats = {c: [("", t) for t in turns] for c, turns in enumerate(chats)}
    groups = {}
    for c, turns in enumerate(chats):
        groups.setdefault(b"".join(map(entry, turns)), []).append(c)
    paths = sorted(groups)
    counts = [(len(groups[p]), min(groups[p]), hashlib.sha256(",".join(map(str, groups[p])).encode()).hexdigest()) for p in paths]
    edges = sorted({0, len(paths), *(min(c, len(paths)) for c in cuts)})
    total, names = {}, {}
    alone = []
    for a, b in zip(edges, edges[1:]):
        nodes, parents = T.Forest(paths[a:b], counts[a:b], paths[a - 1] if a else None, paths[b] if b < len(paths) else None).grown()
        for node, p in zip(nodes, parents):
            above = None if p < 0 else nodes[p]
            if node[7] is None:
                alone.append((node, above))
            else:
                old = total.get(node[7])
                total[node[7]] = (node, above) if old is None else ((node[0], min(node[1], old[0][1]), *(x + y for x, y in zip(node[2:6], old[0][2:6])), node[6] or old[0][6], node[7]), above)
    names = {k: n[1] for k, (n, _) in total.items()}
    out = [(n[1], n[0], above and names.get(above[7], above[1]), *n[2:6], n[6] or T.NO_ENDS) for n, above in [*alone, *total.values()]]
    assert sorted(out, key=str) == nodes_of(given_chats)
