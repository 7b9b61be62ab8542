import hashlib
import re

from campanula.llm import pii

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def luhn(s):
    d = [int(c) for c in s[::-1]]
    return (sum(d[::2]) + sum(sum(divmod(2 * x, 10)) for x in d[1::2])) % 10 == 0


def base(text):
    digits = lambda m: re.sub(r"\D", "", m[0])
    out = [("email", *m.span()) for m in EMAIL.finditer(text)]
    out += [("ip", *m.span()) for m in IP.finditer(text) if all(int(p) <= 255 for p in m[0].split("."))]
    out += [("card", *m.span()) for m in CARD.finditer(text) if 13 <= len(digits(m)) <= 19 and luhn(digits(m))]
    out += [("phone", *m.span()) for m in PHONE.finditer(text) if 9 <= len(digits(m)) <= 15]
    return out


def test_whole_table_against_plain_expressions(both):
    got = {(r.doc_id): r for r in pii.pii_digest(both).where("doc_id < 1000900").collect()}
    for r in both.where("doc_id < 1000900").collect():
        want = base(r.text or "")
        g = got[r.doc_id]
        text = ",".join(f"{k}:{s}:{e}" for k, s, e in want)
        assert g.base_sha256 == hashlib.sha256(text.encode()).hexdigest(), r.text
        assert [g.n_email, g.n_ip, g.n_card, g.n_phone] == [sum(k == w[0] for w in want) for k in pii.BASE_KINDS]
        assert [s for s in g.spans.split(",") if s and s.split(":")[0] in pii.BASE_KINDS] == [t for t in text.split(",") if t]


def test_random_strings():
    import random
    rng = random.Random(5)
    scan = pii.Scanner()
    for _ in range(20_000):
        t = "".join(rng.choice("ab@.1+ (-)9425é") for _ in range(rng.randrange(40)))
        assert [s for s in scan.spans(t) if s[0] in pii.BASE_KINDS] == base(t), t


def test_added_kinds_and_redaction(spark):
    text = ('write joe (at) example (dot) org or see https://a.example.com/x?y=1, IBAN: GB82 WEST 1234 5698 7654 32 then; '
            'SSN 123-45-6789; token = "abc123def4567"; account no. 12345678; lives at 12 Long Street, and a@b.cd')
    found = {k: text[s:e] for k, s, e in pii.Scanner().spans(text)}
    assert found["url"] == "https://a.example.com/x?y=1" and found["iban"] == "GB82 WEST 1234 5698 7654 32"
    assert found["national_id"] == "123-45-6789" and found["secret"] == "abc123def4567" and found["account"] == "12345678"
    assert found["street"] == "12 Long Street" and found["spelled_email"] == "joe (at) example (dot) org" and found["email"] == "a@b.cd"
    df = spark.createDataFrame([(1, text), (2, None), (3, "")], "doc_id long, text string")
    out = {r.doc_id: r.text for r in pii.redact(df).collect()}
    assert "[IBAN]" in out[1] and "GB82" not in out[1] and "a@b.cd" not in out[1] and out[2] is None and out[3] == ""


def test_odd_input(edge, empty):
    assert pii.pii_digest(empty).count() == 0
    out = pii.find_pii(edge)
    assert out.count() == edge.count() and out.columns == [*edge.columns, "pii"]
