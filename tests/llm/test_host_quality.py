"""Quality rules against brute force, host verdicts, odd inputs."""

import random
import re
from collections import Counter

from rivulet.llm import host_quality as Q

SCHEMA = "doc_id bigint, text string, source string, host string, base_failed int"


def brute(t):
    t = t or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", t)
    grams = [tuple(w[i:i + 3]) for i in range(len(w) - 2)]
    n = Counter(grams)
    rep = {j for i, g in enumerate(grams) if n[g] > 1 for j in (i, i + 1, i + 2)}
    lines = [x for x in t.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(rep),
            len(w) < 50 or 100 * len(rep) > 50 * len(w))


def rows():
    rng = random.Random(6)
    words = ["a", "b", "cc", "é😀", "#x", "<y>", "\x1c"]
    out = [(i, "".join(rng.choice(words) + rng.choice([" ", " ", "\n", "\t ", "\r\n"]) for _ in range(rng.randint(0, 90))),
            f"h{i % 3}") for i in range(150)]
    out += [(900 + i, " ".join(f"w{j}" for j in range(60)), "good") for i in range(40)]
    out += [(950 + i, "bad", "bad") for i in range(30)] + [(985, " ".join(f"w{j}" for j in range(60)), "bad")]
    return out + [(990, None, None), (991, "", "new"), (992, "x " * 20_000, "h0"), (None, "y", "h1"), out[0]]


def test_counts_and_verdicts(spark):
    data = rows()
    df = spark.createDataFrame([(*r, "x", 7) for r in data], SCHEMA)
    got = Q.judge(df).collect()
    key = lambda r: tuple((x is not None, x or 0) for x in r)
    cols = ("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
    assert sorted((tuple(r[c] for c in cols) for r in got), key=key) == sorted(((i, *brute(t)) for i, t, _ in data), key=key)
    host = {r.doc_id: r for r in got}
    assert host[985].host_rejected and not host[985].base_failed and not host[985].kept
    assert all(host[900 + i].kept for i in range(40))
    assert host[990].host_docs == 1


def test_keep_agrees_with_judge(spark):
    data = rows()
    df = spark.createDataFrame([(*r, "x", 7) for r in data], SCHEMA)
    kept = Q.keep(df)
    assert kept.columns == df.columns
    want = sorted(r.doc_id for r in Q.judge(df).collect() if r.kept)
    assert sorted(r.doc_id for r in kept.collect()) == want
    assert Q.judge(df.limit(0)).collect() == [] and Q.keep(df.limit(0)).collect() == []


def test_hosts_credibly_worse_than_the_others(spark):
    """Of 30 hosts one has symbols in 60 of 100 texts: its clean texts go too;
    one with 5 of 8 is not certain, one with 20 of 100 stays below the floor."""
    def doc(i, bad):
        return " ".join(f"w{i}x{j}" for j in range(60)) + " #$%&|<>" * bad

    data, i = [], 0
    for h in range(30):
        for k in range(100):
            i += 1
            data.append((i, doc(i, k < 2 + h % 3), f"h{h}", "x", 1))
    for host, n, bad in (("worse", 100, 60), ("few", 8, 5), ("somewhat", 100, 20)):
        for k in range(n):
            i += 1
            data.append((i, doc(i, k < bad), host, "x", 1))
    df = spark.createDataFrame(data, SCHEMA)
    got = Q.judge(df)
    assert [r.host for r in got.where("host_rejected").select("host").distinct().collect()] == ["worse"]
    assert {r.host for r in got.where("NOT kept").select("host").distinct().collect()} == {"worse"}
    assert got.where("NOT base_failed").count() == len(data)
    assert Q.keep(df).where("source = 'worse'").count() == 0 and Q.keep(df).count() == len(data) - 100
