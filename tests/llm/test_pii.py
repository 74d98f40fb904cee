"""Personal data: base spans against Python's patterns, and the label model."""

import hashlib
import random
import re

from rivulet.llm import pii

# as the contract states them
PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(d):
    return sum(x if i % 2 == 0 else sum(divmod(2 * x, 10)) for i, x in enumerate(map(int, reversed(d)))) % 10 == 0


def base(t):
    out = []
    for k, kind in enumerate(pii.KINDS):
        for m in re.finditer(PATTERNS[kind], t or ""):
            v = m.group()
            d = re.sub("[^0-9]", "", v)
            ok = {"email": True, "ip": all(int(x) <= 255 for x in v.split(".")) if kind == "ip" else 0,
                  "card": 14 <= len(d) <= 19 and luhn(d), "phone": 10 <= len(d) <= 15}[kind]
            if ok:
                out.append((m.start(), k, m.end()))
    return sorted(out)


def spans(spark, rows):
    df = spark.createDataFrame([(i, t, "v", 1) for i, t in rows], "doc_id bigint, text string, v string, k int")
    return [(r.doc_id, r.text, [tuple(x) for x in r["__base"]], [tuple(x) for x in r["__spans"]])
            for r in pii.find(df).collect()]


def test_base_spans_of_random_texts(spark):
    rng = random.Random(2)
    parts = ["a@b.co", "x_y@c.d-e.f", "@", "..", "_d@e.f", "1.2.3.4", "256.1.1.1", "00012.3.4.255", "1.2.3.4.5", "+1 (017) 555-7713",
             "+49-30 1234567", "+1", "4111 1111 1111 1111", "4111-1111-1111-1111", "4785380592391139", "0", "12", " ", "  ", "-",
             "é", "😀", "\n", "$", "79927398713", ".", "word", "4111111111111111111111"]
    rows = [(i, "".join(rng.choice(parts) for _ in range(rng.randint(0, 12)))) for i in range(600)]
    rows += [(900, None), (901, ""), (902, "1" * 30_000), (903, "1 2 " * 8_000), (904, "a" * 60_000 + "@"),
             (905, "a@b" + ".c" * 20_000), (906, "+1" + " 2" * 20_000), (None, "me a@b.co"), (3, rows[3][1])]
    for i, t, b, s in spans(spark, rows):
        assert b == base(t), (t or "")[:80]
        assert set(b) <= set(s)


def test_candidates_are_added_by_agreement(spark):
    rows = [(i, f"please call 0{i % 9}1 555 {1000 + i} now") for i in range(60)]
    rows += [(100 + i, f"phone +1 (617) 555-{1000 + i}") for i in range(60)]
    rows += [(300 + i, f"order id x117 555 {1000 + i}y") for i in range(60)]
    rows += [(500 + i, f"the value 345 555 {1000 + i} here") for i in range(20)]
    rows += [(400, "write to jane.doe (at) mail (dot) example (dot) org"), (401, "write to a@b.com")]
    got = {i: s for i, _, _, s in spans(spark, rows)}
    assert all(len(got[i]) == 1 for i in range(60))
    assert not any(got[300 + i] for i in range(60)) and not any(got[500 + i] for i in range(20))
    assert len(got[400]) == 1


def test_candidates_without_a_keyword(spark):
    rows = [(i, f"please call 0{i % 9}1 555 {1000 + i} now") for i in range(60)]
    rows += [(100 + i, f"phone +1 (617) 555-{1000 + i}") for i in range(60)]
    rows += [(300 + i, f"order id x117-555-{1000 + i}y") for i in range(60)]
    rows += [(500, "J. Smith, (212) 555-0143"), (501, "J. Smith, 212.555.0143"), (502, "J. Smith, 030 555 0143"),
             (503, "seen 2001:db8:0:0:0:ff00:42:8329 twice"), (504, "jane.doe [at] mail [dot] example [dot] org"),
             (505, "jane.doe (At) example.org"), (506, "jane.doe [aT] example.org"),
             # bare numbers: a keyword is needed
             (600, "the value 345 555 1000 here"), (601, "a ratio of 1:2:3:4:5:6:7:8"), (602, "the sum 4111 1111 1111 1112")]
    got = {i: s for i, _, _, s in spans(spark, rows)}
    kinds = {i: [pii.KINDS[k] for _, k, _ in s] for i, s in got.items() if i >= 500}
    assert kinds == {500: ["phone"], 501: ["phone"], 502: ["phone"], 503: ["ip"], 504: ["email"], 505: ["email"],
                     506: ["email"], 600: [], 601: [], 602: []}
    assert not any(got[300 + i] for i in range(60))  # the classifier's no


def test_redaction(spark):
    rows = [(1, "mail a@b.co, é +1 (017) 555-7713!", 33), (2, "nothing", 7), (3, None, None), (4, "", 0)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, n_chars bigint")
    got = sorted(tuple(r) for r in pii.redact(df).collect())
    assert got == [(1, "mail <EMAIL>, é <PHONE>!", 24), (2, "nothing", 7), (3, None, None), (4, "", 0)]
    assert pii.redact(df.limit(0)).collect() == []


def test_whole_table(spark):
    from rivulet.llm.queries import QUERIES
    from tests.conftest import SF_SMALL
    got = {r.doc_id: r for r in QUERIES["op8_weak_pii"](spark, SF_SMALL).collect()}
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect()
    assert len(got) == len(docs)
    some = 0
    for i, t in docs:
        b = base(t)
        text = ",".join(f"{pii.KINDS[k]}:{s}:{e}" for s, k, e in b)
        r = got[i]
        assert r.base_sha256 == hashlib.sha256(text.encode()).hexdigest()
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(x[1] == k for x in b) for k in range(4)]
        some += len(b)
    assert some
