"""Language, secrets, quality and personal data against plain versions, and on the awkward rows."""

import hashlib
import math
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from loomwork.llm import language, pii, quality, secrets
from loomwork.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def documents(spark, texts, **extra):
    rows = [(i, t, "en", "s", None) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, DOCS)
    for name, value in extra.items():
        df = df.withColumn(name, F.lit(value))
    return df


# Null, empty, blank, no letter, one letter, line ends only, wide characters, a repeated row.
AWKWARD = [None, "", "   \n\t ", "12 + 34", "a", "\n\n\n", "äöü ß 漢字 🙂", "same row", "same row"]


# ---------------------------------------------------------------- language

def plain_code_length(texts, text, order):
    """Escape method C by the book, counting again for every byte."""
    counts = {}
    for t in texts:
        padded = bytes(order) + t
        for i, b in enumerate(t):
            for k in range(order + 1):
                counts.setdefault(padded[i + order - k:i + order], {}).setdefault(b, 0)
                counts[padded[i + order - k:i + order]][b] += 1
    bits, padded = 0.0, bytes(order) + text
    for i, b in enumerate(text):
        for k in range(order, -1, -1):
            seen = counts.get(padded[i + order - k:i + order])
            if seen is None:
                continue
            n, d = sum(seen.values()), len(seen)
            if b in seen:
                bits -= math.log2(seen[b] / (n + d))
                break
            bits -= math.log2(d / (n + d))
        else:
            bits += 8
    return bits


@pytest.mark.parametrize("part", [1, 7, 64])
def test_code_lengths_and_words_do_not_depend_on_the_parts(monkeypatch, part):
    model = language.train({"a": [b"abracadabra abra", b"cadabra"], "b": [b"hocus pocus", b"pocus hocus hocus"]})
    rng = random.Random(8)
    texts = ["".join(rng.choice("abrchous pé1 ,") for _ in range(rng.randrange(60))) for _ in range(40)] + ["", "x1 22", "1a 2b, 3c-d"]
    raw = [t.encode() for t in texts]
    borders = np.concatenate([[0], np.cumsum([len(r) for r in raw])]).astype(np.int64)
    data = np.frombuffer(b"".join(raw), np.uint8)
    whole, words = model.code_lengths(data, borders), [language.words_of(t) for t in texts]
    monkeypatch.setattr(language, "_PART", part)
    assert np.allclose(model.code_lengths(data, borders), whole, rtol=1e-5)
    assert [language.words_of(t) for t in texts] == words and words[-1] == "a b c d"


def test_code_lengths_are_those_of_the_plain_model():
    texts = {"a": [b"abracadabra abra", b"cadabra"], "b": [b"hocus pocus", b"pocus hocus hocus"]}
    model = language.train(texts, order=3)
    asked = [b"abra pocus", b"x", b"cadabra hocus!", b""]
    data = np.frombuffer(b"".join(asked), np.uint8)
    borders = np.concatenate([[0], np.cumsum([len(t) for t in asked])])
    got = model.code_lengths(data, borders)
    for i, text in enumerate(asked):
        for j, name in enumerate(model.languages):
            assert got[i, j] == pytest.approx(plain_code_length(texts[name], text, 3), abs=1e-3)


def test_language_of_held_out_rows(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang", F.length("text").alias("n"))
    rows = QUERIES["op1_language"](spark, SF).join(docs, "doc_id").filter("held_out and n > 100").collect()
    assert rows and sum(r["lang_pred"] == r["lang"] for r in rows) >= 0.97 * len(rows)
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) and 0 <= r["score"] <= 1 for r in rows)


def test_language_awkward_rows(spark):
    docs = documents(spark, [*AWKWARD, "the cat and the dog", "le chat et le chien"] * 3, lang_pred=1, score="x")
    model = language.train({"en": [b"the cat sat and the dog ran"], "fr": [b"le chat et le chien ont couru"]})
    rows = language.identify(docs, model, keep=["doc_id"]).collect()
    pred = {r["doc_id"]: r["lang_pred"] for r in rows}
    assert [pred[i] for i in range(4)] == ["und"] * 4 and pred[5] == "und" and pred[9] == "en" and pred[10] == "fr"
    assert pred[7] == pred[8] and len(rows) == 33
    assert all(r["score"] == 0 for r in rows if r["lang_pred"] == "und")
    assert {r["lang_pred"] for r in language.identify(docs, None, keep=["doc_id"]).collect()} == {"und"}
    assert language.fit(docs.filter("false")) is None and language.fit(docs.withColumn("lang", F.lit(None).cast("string"))) is None
    assert language.identify(docs.filter("false"), model, keep=["doc_id"]).count() == 0


# ---------------------------------------------------------------- secrets

ASSIGN = re.compile(r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")


def plain_secrets(text):
    text = text or ""
    spans = [("assign", m.start(), m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    spans += [("access", m.start(), m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    spans += [("hex", m.start(), m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    kinds = ["assign", "access", "hex"]
    return sorted(spans, key=lambda s: (s[1], kinds.index(s[0])))


def scanned(spark, texts):
    rows = secrets.scan_secrets(documents(spark, texts, secrets="x", t=1), keep=["doc_id"]).collect()
    return {r["doc_id"]: [tuple(s) for s in r["secrets"]] for r in rows}


def test_base_secrets_equal_the_plain_scan(spark):
    rng = random.Random(5)
    parts = ["password", "PassWd", "secret", "token=", "api_key", "APIKEY", ":", "=", " ", "  ", "'", '"', "AKIA", "AKIAAKIA", "ABCDEFGH01234567", "0123456789abcdef",
             "deadbeef", "abcdef", "short", "ſecret=abcdefgh", "toKen=abcdefgh", "ä", "漢", "\n", "hunter22", "xyz=", "tokentoken=abcdef1", "a" * 11, "f" * 30]
    texts = ["".join(rng.choices(parts, k=rng.randint(1, 14))) for _ in range(1500)] + AWKWARD
    got = scanned(spark, texts)
    for i, text in enumerate(texts):
        assert [s for s in got[i] if s[0] in secrets.BASE] == plain_secrets(text), text
    rows = QUERIES["op2_secrets"](spark, SF).collect()
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    for r in rows:
        want = plain_secrets(docs[r["doc_id"]])
        assert r["base_sha256"] == hashlib.sha256(",".join(f"{k}:{a}:{b}" for k, a, b in want).encode()).hexdigest()
        assert (r["n_assign"], r["n_access"], r["n_hex"]) == tuple(sum(s[0] == k for s in want) for k in secrets.BASE)


def test_checksums_inside_the_value(spark):
    body = b"a1B2c3D4e5F6g7H8i9J0k1L2m3N4o5"
    good = "ghp_" + (body + secrets.base62_crc(body)).decode()
    bad = good[:-1] + ("0" if good[-1] != "0" else "1")
    der = b"\x30\x05\x02\x03abc"
    import base64
    pem = f"-----BEGIN PRIVATE KEY-----\n{base64.b64encode(der).decode()}\n-----END PRIVATE KEY-----"
    got = scanned(spark, [f"é {good} x", f"é {bad} x", good.replace("ghp_", "npm_"), pem, pem.replace("MAU", "MAY")])
    assert got[0] == [("github", 2, 2 + len(good))] and got[1] == []
    assert [s[0] for s in got[2]] == ["npm"] and [s[0] for s in got[3]] == ["pem"] and got[4] == []


def test_long_texts_and_redaction(spark):
    long = "a" * 300_000 + " token=abcdefgh " + "0123456789abcdef" * 5000 + " ä" * 1000 + "secret: zzzzzzzz"
    docs = documents(spark, [long, None, "x password=hunter2222 y", "clean"])
    got = scanned(spark, [long])[0]
    assert [s for s in got if s[0] in secrets.BASE] == plain_secrets(long)
    rows = {r["doc_id"]: r for r in secrets.redact(docs).collect()}
    assert rows[2]["text"] == "x <secret> y" and rows[1]["text"] is None and rows[3]["text"] == "clean"
    assert rows[0]["text"].count("<secret>") == 4 and "abcdefgh" not in rows[0]["text"] and rows[0].asDict().keys() == {"doc_id", "text", "lang", "source", "n_chars"}
    assert secrets.scan_secrets(docs.filter("false")).count() == 0


# ---------------------------------------------------------------- quality

def plain_quality(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [line for line in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", line)]
    windows = [tuple(words[i:i + 5]) for i in range(len(words) - 4)]
    covered = {j for i, w in enumerate(windows) if windows.count(w) > 1 for j in range(i, i + 5)}
    n = len(words)
    return (n, sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered),
            n < 10 or 100 * len(covered) > 20 * n)


def test_quality_measures(spark):
    rng = random.Random(3)
    texts = [*AWKWARD, "a b c d e a b c d e", "x " * 400, "line one here\nline one here\n\nline one here",
             *["".join(rng.choice(["ab", "cd", "é", "#", " ", " ", "\n", "\x0b", " ", "."]) for _ in range(rng.randint(0, 150))) for _ in range(150)]]
    rows = quality.measure(documents(spark, texts, n_words="clash", _words=1, lost=2), keep=["doc_id", "source"]).collect()
    assert len(rows) == len(texts)
    for r in rows:
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"], r["base_failed"]) == plain_quality(texts[r["doc_id"]])
        assert not (r["kept"] and r["base_failed"])
    assert quality.measure(documents(spark, ["x"]).filter("false")).count() == 0


def test_lines_are_cleaned_before_the_verdict(spark):
    prose = "This line has quite a few words and it ends as it should."
    menu = "\n".join(["Home", "About us", "Login", "Share | Print | Mail | Top", "We use cookies to make this site work, accept cookies now."])
    more = "Another sentence follows here with other words than those above."
    docs = documents(spark, [f"{prose}\n{menu}\n{more}", f"{menu}\n{menu}x\nshort line here ok.", None])
    cleaned = {r["doc_id"]: r["clean_text"] for r in quality.clean_lines(docs).collect()}
    assert cleaned[0] == f"{prose}\n{more}" and cleaned[2] is None
    kept = {r["doc_id"]: r["kept"] for r in quality.measure(docs, keep=["doc_id"]).collect()}
    assert kept == {0: True, 1: False, 2: False}


# ---------------------------------------------------------------- personal data

def luhn(digits):
    total = 0
    for i, d in enumerate(reversed(digits)):
        d = int(d) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def plain_pii(text):
    text, spans = text or "", []
    digits = lambda s: re.sub("[^0-9]", "", s)
    for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text):
        spans.append(("email", m.start(), m.end()))
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(p) <= 255 for p in m[0].split(".")):
            spans.append(("ip", m.start(), m.end()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        if 16 <= len(digits(m[0])) <= 19 and luhn(digits(m[0])):
            spans.append(("card", m.start(), m.end()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 8 <= len(digits(m[0])) <= 15:
            spans.append(("phone", m.start(), m.end()))
    return spans


def test_base_personal_data_equals_the_plain_scan(spark):
    rng = random.Random(9)
    parts = ["a@b.c", "x_y@m-n.org", "@", ".", "..", "ab", "_", "10.0.0.1", "255.256.1.2", "007.1.2.3", "4539 1488 0343 6467", "4539148803436467", "1234-5678-9012-3456", "12",
             "3", "-", " ", "  ", "+", "+1 (988) 555-2485", "+49.30.123456", "(", ")", "ä", "漢", "🙂", "\n", "%", "0"]
    texts = ["".join(rng.choices(parts, k=rng.randint(1, 12))) for _ in range(1500)] + AWKWARD
    rows = pii.extract(documents(spark, texts, spans="x", id="y", kind=3)).collect()
    assert len(rows) == len(texts)
    for r in rows:
        assert [(s["kind"], s["start"], s["end"]) for s in r["spans"] if s["kind"] != "ctx"] == plain_pii(texts[r["doc_id"]]), texts[r["doc_id"]]


def test_personal_data_query(spark):
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    for r in QUERIES["op10_personal_data"](spark, SF).collect():
        want = plain_pii(docs[r["doc_id"]])
        assert r["base_sha256"] == hashlib.sha256(",".join(f"{k}:{a}:{b}" for k, a, b in want).encode()).hexdigest()
        assert (r["n_email"], r["n_ip"], r["n_card"], r["n_phone"]) == tuple(sum(s[0] == k for s in want) for k in pii.KINDS)


def test_long_runs_stay_linear(spark):
    texts = ["a" * 200_000 + "@" + "b" * 100_000, "1" * 200_000, "1.2.3.4 " * 1000 + "x@y.zz", "+1" + " (" * 50_000, "z" * 100_000 + " 7 w"]
    rows = {r["doc_id"]: r["spans"] for r in pii.extract(documents(spark, texts)).collect()}
    base = {i: [s["kind"] for s in spans if s["kind"] != "ctx"] for i, spans in rows.items()}
    assert base == {0: [], 1: [], 2: ["email"] + ["ip"] * 1000, 3: [], 4: []}


def test_patterns_learned_from_seeds_find_unseen_identifiers(spark):
    seeds = [f"wrote to mail ann{i}@host.example today" for i in range(8)]
    unseen = ["wrote to mail bob@host today", "room 12 is free", "room 13 is free", "room 14 is free"]
    rows = {r["doc_id"]: r["spans"] for r in pii.extract(documents(spark, seeds + unseen)).collect()}
    assert all(s["kind"] == "email" for i in range(8) for s in rows[i])
    assert [(s["kind"], s["value"]) for s in rows[8]] == [("ctx", "bob@host")]  # another shape in the same context
    assert rows[9] == rows[10] == rows[11] == []  # patterns without seeds
    more = [f"call phone +49 30 12345{i} now" for i in range(6)] + ["call phone +49x now"]
    assert len(pii.extract(documents(spark, more)).collect()) == 7
    cards = [f"card no {n} ok" for n in ("4539148803436467", "4716461583322103", "4024007103939509", "4485275742308327")]
    found = {r["doc_id"]: r["spans"] for r in pii.extract(documents(spark, cards * 2 + ["card no 4539148803436468 ok"])).collect()}
    assert [(s["kind"], s["value"]) for s in found[8]] == [("ctx", "4539148803436468")]
    assert pii.extract(documents(spark, ["x"]).filter("false")).count() == 0


def test_patterns_of_two_words_reach_over_a_token_before(spark):
    texts = [f"see account 4711 {n} ok" for n in ("ann@host.example", "+49 30 123456", "10.0.0.1", "bob@host.example")] + ["the account 4711 AB34xy ok", "a 4711 AB34xy"]
    rows = {r["doc_id"]: r["spans"] for r in pii.extract(documents(spark, texts)).collect()}
    assert [(s["kind"], s["value"]) for s in rows[4]] == [("ctx", "AB34xy")] and rows[5] == []
    found = spark.createDataFrame([("x no. 12 AB34 7 @q  r 5",)], "t string").select(pii.contexts(F.col("t")).alias("c")).first()["c"]
    assert [[p for p in c["patterns"] if "  " not in p] for c in found] == [["x no."], ["no. 12"], ["12 ab34"], ["ab34 7"], ["@q r"]]


def test_a_language_with_long_texts_only_is_learned(spark):
    docs = documents(spark, ["the cat and the dog ran " * 3, "le chat et le chien ont couru " * 9, "le chat et le chien ont couru vite " * 8, "le chien et le chat"])
    docs = docs.withColumn("lang", F.when(F.col("doc_id").isin(1, 2), "fr").when(F.col("doc_id") == 0, "en"))
    model = language.fit(docs, max_chars=100)
    assert model.languages == ["en", "fr"]
    assert {r["doc_id"]: r["lang_pred"] for r in language.identify(docs, model, keep=["doc_id"]).collect()} == {0: "en", 1: "fr", 2: "fr", 3: "fr"}
    assert language.fit(docs, max_chars=10).languages == ["en", "fr"]  # a table of long texts only
