import hashlib
import random
import re

from hypothesis import given, settings, strategies as st

from playtrail.llm import pii
from playtrail.llm.pii import detect, find, redact

PLAIN = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
         "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def plain_ok(kind, text):
    digits = re.sub("[^0-9]", "", text)
    if kind == "ip":
        return all(int(p) <= 255 for p in text.split("."))
    if kind == "card":
        total = sum(int(d) if i % 2 == 0 else (int(d) * 2 - 9 if int(d) > 4 else int(d) * 2) for i, d in enumerate(digits[::-1]))
        return 13 <= len(digits) <= 19 and total % 10 == 0
    return kind != "phone" or 9 <= len(digits) <= 15


def plain(text):
    return [(k, *m.span()) for k, p in PLAIN.items() for m in re.finditer(p, text or "") if plain_ok(k, m.group())]


def base(text):
    return [s[:3] for s in find(text) if s[0] in pii.BASE]


@settings(max_examples=600, deadline=None)
@given(st.text(alphabet="a1290.@+-() %5é", max_size=60))
def test_base_spans_are_those_of_the_plain_patterns(text):
    assert base(text) == plain(text)


def test_base_spans_on_mixed_texts():
    rng = random.Random(3)
    parts = ["a@b.c", "x.y+z@mail-1.example.com", "@a.b@c.d", "1.2.3.4", "256.1.1.1", "0255.1.1.01", "1.2.3.4.5.6.7.8", "4111 1111 1111 1111",
             "4111-1111-1111-1112", "+1 (437) 555-0689", "+49 30 1234567", "+1", "00000000000000", "é", "\n", " ", "word"]
    for _ in range(3000):
        text = "".join(rng.choice(parts) + rng.choice(["", " ", ".", "-"]) for _ in range(rng.randint(0, 9)))
        assert base(text) == plain(text), text


def test_added_spans_need_a_checksum_or_words():
    kinds = lambda t: [s[0] for s in find(t)]
    assert kinds("to DE89 3704 0044 0532 0130 00 NOW") == ["iban"]
    assert kinds("to DE88 3704 0044 0532 0130 00") == []
    assert kinds("her ssn is 123-45-6789") == ["ssn"] and kinds("see 123-45-6789") == []
    assert kinds("call (437) 555-0689 now") == ["tel"] and kinds("at (437) 555-0689") == []
    assert kinds("credit card 12345 4111 1111 1111 1111 no") == ["card_part"]
    assert pii.luhn("4111111111111111") and not pii.luhn("4111111111111112") and pii.mod97("GB82WEST12345698765432")


def test_long_texts_take_linear_time():
    for text in ("1" * 300_000, "a" * 300_000 + "@", "1." * 150_000, "+1" + "(" * 300_000, "1 " * 150_000, "A1 " * 100_000):
        assert find(text) is not None


def test_rows_and_edges(spark, frame):
    rows = [(1, "mail a@b.co or +1 (437) 555-0689", 33, "x"), (2, None, None, None), (2, "", 0, "y"), (None, "10.0.0.1", 8, "z"), (1, "plain", 5, "x")]
    docs = frame(rows, "doc_id long, text string, n_chars long, found string")
    got = {(r.doc_id, r.spans): r for r in detect(docs).collect()}
    assert got[(1, "email:5:11,phone:15:32")].n_phone == 1
    assert got[(2, "")].base_sha256 == hashlib.sha256(b"").hexdigest() and got[(None, "ip:0:8")].n_ip == 1
    out = redact(docs)
    assert out.columns == docs.columns and out.count() == 5
    masked = [r for r in out.collect() if r.doc_id == 1 and r.found == "x"]
    assert sorted((r.text, r.n_chars) for r in masked) == [("mail [EMAIL] or [PHONE]", 23), ("plain", 5)]
    assert detect(docs.limit(0)).count() == 0 and redact(docs.limit(0)).count() == 0
    assert detect(docs).count() == 5


def test_whole_table(spark):
    sf = "/root/testdata/sf0.001"
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    for r in detect(spark.read.parquet(f"{sf}/documents.parquet")).collect():
        want = plain(texts[r.doc_id])
        assert r.base_sha256 == hashlib.sha256(",".join(f"{k}:{a}:{b}" for k, a, b in want).encode()).hexdigest()
        assert (r.n_email, r.n_ip, r.n_card, r.n_phone) == tuple(sum(w[0] == k for w in want) for k in pii.BASE)


def test_every_number_of_a_run_is_found():
    spans = lambda t: [(s[0], t[s[1]:s[2]]) for s in find(t)]
    visa, master, amex = "4111 1111 1111 1111", "5500-0000-0000-0004", "3782 822463 10005"
    assert spans(f"card {visa} {master} end") == [("card_part", visa), ("card_part", master)]
    assert spans(f"card {master}-{visa} {amex} {visa} end") == [("card_part", c) for c in (master, visa, amex, visa)]
    assert spans(f"card 12345 {visa} 99 {master}") == [("card_part", visa), ("card_part", master)]
    assert spans(f"card 41 11 11 11 11 11 11 1 1 {master}") == [("card_part", "41 11 11 11 11 11 11 1 1"), ("card_part", master)]
    one, two = "DE89 3704 0044 0532 0130 00", "GB82 WEST 1234 5698 7654 32"
    assert spans(f"to {one} {two} {one}") == [("iban", one), ("iban", two), ("iban", one)]
    assert spans(f"to AB12 CD {one}") == [("iban", one)] and spans(f"to DE88 3705 0044 {two} NOW") == [("iban", two)]
