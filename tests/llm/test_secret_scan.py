"""Secret scan against a plain restatement in Python and against its statement, on odd texts."""

import hashlib
import math
import random
import re

import duckdb
import pytest
from pyspark.sql import functions as F

from paddock.llm import queries, secret_scan, statements

BASE = (
    ("assign", re.compile(secret_scan.ASSIGN)),
    ("access", re.compile(r"AKIA[A-Z0-9]+")),
    ("hex", re.compile(r"[0-9a-f]+")),
)


def plain(text):
    """(base, all) spans as strings."""
    text = text or ""
    base = []
    for rank, (kind, pattern) in enumerate(BASE):
        for m in pattern.finditer(text):
            if len(m[2]) >= 8 if kind == "assign" else len(m[0]) >= {"access": 16, "hex": 32}[kind]:
                base.append((m.start(), rank, m.end()))
    extra = []
    for rank, c in enumerate(secret_scan.CLASSES, 3):
        for m in re.finditer(f"[{c.characters}]{{{secret_scan.WINDOW},}}", text):
            word, before = m[0], text[: m.start()]
            runs = [r for r in re.split("[^A-Za-z0-9]+", word) if r]
            named = all(re.fullmatch("[A-Z]?[a-z]+|[A-Z]+|[0-9]{1,8}", r) for r in runs)
            if named or any(re.search(p, word) for p in secret_scan.ALLOWED) or re.search(secret_scan.ALLOWED_BEFORE.replace(r"\z", r"\Z"), before):
                continue
            if not all(re.search(n, word) for n in c.needs):
                continue
            covered = set()
            for i in range(len(word) - secret_scan.WINDOW + 1):
                window = word[i : i + secret_scan.WINDOW]
                shares = [window.count(ch) / len(window) for ch in set(window)]
                if -sum(p * math.log2(p) for p in shares) >= c.bits - 1e-6:
                    covered.update(range(i, i + len(window)))
            for at in sorted(covered):
                if at - 1 not in covered:
                    end = at
                    while end in covered:
                        end += 1
                    span = (m.start() + at, rank, m.start() + end)
                    if not any(s <= span[0] and span[2] <= e for s, _, e in base):
                        extra.append(span)
    write = lambda spans: ",".join(f"{secret_scan.KINDS[k]}:{s}:{e}" for s, k, e in sorted(spans))
    return write(base), write(base + extra)


def key(rnd, n, alphabet="ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"):
    return "".join(rnd.choice(alphabet) for _ in range(n))


def odd_texts():
    rnd = random.Random(8)
    digits = "0123456789abcdef"
    texts = [
        None, "", " \n", "nothing to see here", 'password="hunter2hunter2" and Password : short', "token:secret:abcdefghij", "API_KEY='A.b-c_d=e/f+9'",
        "apikey==abcdefgh", "ſecret = abcdefghijk, toKen = abcdefghijk", "é🙂 AKIA" + key(rnd, 12, "ABCDEFGH0123") + " AKIAAKIA short AKIA1", key(rnd, 31, digits) + " " + key(rnd, 32, digits),
        "x" + key(rnd, 40, digits) + "g" + key(rnd, 64, digits), key(rnd, 24, digits), key(rnd, 24, "0123456789ABCDEF"), "k " + key(rnd, 40), "data:image/png;base64," + key(rnd, 80),
        "sha256-" + key(rnd, 44), "123e4567-e89b-12d3-a456-426614174000", "path/to/SomeThing/with_words/2024/01/02/file_name", "getUserAccountBalanceHistoryForMonth", "A1b2" * 10 + "=" * 30,
        "EXAMPLE" + key(rnd, 30), "q9Zx" + "a" * 60 + key(rnd, 40), key(rnd, 15) + "aaaaaaa" + key(rnd, 12) + "0000000" + key(rnd, 20), "aB3" * 9, "日本" + key(rnd, 25) + "語" + key(rnd, 33) + "\n" + key(rnd, 20),
        "ab1 " * 3000 + key(rnd, 5000) + " end", "".join(key(rnd, 22) + rnd.choice([" ", ".", "é", "\n"]) for _ in range(400)), "secret " * 500 + "= " + key(rnd, 30),
        "m" * 3000 + "1A" + "m" * 50, key(rnd, 2040) + "a1B" * 40 + key(rnd, 2100),
    ]
    texts += ["".join(rnd.choice(["token", "=", " ", '"', "AKIA", "aB3dE5fG7", "0f", "é", ":", "deadbeef01", "-", "Zz9"]) for _ in range(60)) for _ in range(120)]
    return texts + [texts[13], texts[13]]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame([(i % 150, t, "x", 1) for i, t in enumerate(odd_texts())], "doc_id long, text string, spans string, found_hex int")


def found(docs):
    out = secret_scan.find_secrets(docs, "text", {"doc_id": docs["doc_id"], "text": docs["text"]})
    return out.collect()


def test_odd_texts_against_plain(odd):
    rows = found(odd)
    assert len(rows) == len(odd_texts())
    for r in rows:
        assert (r["base_spans"], r["spans"]) == plain(r["text"]), r["text"]
        assert [r[f"n_{k}"] for k in ("assign", "access", "hex")] == [r["base_spans"].count(k + ":") for k in ("assign", "access", "hex")]
    assert sum(r["n_entropy"] > 0 for r in rows) > 20


def test_statement_on_odd_texts(odd):
    documents = odd.select("doc_id", "text").toPandas()  # noqa: F841
    names = ["doc_id", "n_assign", "n_access", "n_hex", "n_entropy", "base_sha256", "spans"]
    with duckdb.connect() as con:
        con.register("documents", documents)
        want = con.sql(statements.secret_scan_statement()).df()[names]
    got = secret_scan.find_secrets(odd, "text", {"doc_id": odd["doc_id"]}).withColumn("base_sha256", F.sha2("base_spans", 256)).select(names)
    assert sorted(map(tuple, got.collect())) == sorted(want.itertuples(index=False, name=None))


def test_query_of_given_documents(spark):
    folder = "/root/testdata/sf0.001"
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    for r in queries.op11_secret_scan(spark, folder).collect():
        base, spans = plain(texts[r["doc_id"]])
        assert (r["base_sha256"], r["spans"]) == (hashlib.sha256(base.encode()).hexdigest(), spans)


def test_no_python_and_no_shuffle(spark):
    plan = queries.op11_secret_scan(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Arrow|Pandas|Exchange", plan)


def test_empty_table(spark):
    assert found(spark.createDataFrame([], "doc_id long, text string")) == []
