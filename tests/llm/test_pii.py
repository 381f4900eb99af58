import hashlib
import re
import time

from pyspark.sql import functions as F

from tidemark.llm import pii

PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    return sum(d if i % 2 == 0 else 2 * d - 9 * (d > 4) for i, d in enumerate(map(int, reversed(digits)))) % 10 == 0


def base(text):
    out = []
    for kind, pattern in PLAIN.items():
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            if (kind == "ip" and any(int(p) > 255 for p in m[0].split(".")) or kind == "card" and not (16 <= len(digits) <= 19 and luhn(digits))
                    or kind == "phone" and not 8 <= len(digits) <= 15):
                continue
            out.append(f"{kind}:{m.start()}:{m.end()}")
    return out


TEXTS = [
    None, "", " ", "no data", "mail a.b+c@d-e.co.uk. and x@y.z_w@q.r then @@ a@b a@b. é😀 p@q.rs",
    "1.2.3.4 999.1.1.1 1.2.3.4.5.6.7.8 0.0.0.0 00255.1.1.1 1.2.3 12.34.56.78",
    "4539 1488 0343 6467 x4111111111111111 4111-1111-1111-1111 4111111111111112 1 2 3 4 41111111111111110000 12",
    "+1 (415) 555-0000 +12 +1234567 +12345678 +1.2.3.4.5.6.7.8+9 ((+44 20 7946 0958))",
    "token = \"24be64439e3e49cf46b2\" GB82 WEST 1234 5698 7654 32 GB82WEST12345698765433 ssn 123-45-6789 123-45-6789",
    "a" * 50_000, "1" * 50_000, "a@" + ".b" * 20_000, "1 " * 30_000, "+1" + "(" * 30_000, "x@y.z " * 500,
]


def test_base_spans_equal_plain_search(documents):
    found = pii.find_pii(documents(TEXTS)).select("doc_id", "text", "pii").collect()
    assert len(found) == len(TEXTS)
    for r in found:
        own = [f"{s.kind}:{s.start}:{s.end}" for s in r.pii if s.kind in pii.BASE]
        assert own == base(r.text)


def test_checked_kinds_and_context(documents):
    spans = pii.find_pii(documents([TEXTS[8]])).first().pii
    assert [(s.kind, TEXTS[8][s.start:s.end]) for s in spans if s.kind not in pii.BASE] == [
        ("iban", "GB82 WEST 1234 5698 7654 32"), ("ssn", "123-45-6789"), ("ssn", "123-45-6789"), ("secret", "token = \"24be64439e3e49cf46b2")]
    assert all(s.score >= pii.KEEP_SCORE for s in spans)
    assert not pii.find_pii(documents(["number 123-45-6789"])).first().pii


def test_digest(documents):
    row = pii.find_pii(documents([TEXTS[5]])).select(F.sha2(pii.digest(F.col("pii")), 256).alias("h")).first()
    assert row.h == hashlib.sha256(",".join(base(TEXTS[5])).encode()).hexdigest()


def test_redact(documents):
    rows = {r.doc_id: r.text for r in pii.redact(documents(["é x@y.zz, 1.2.3.4!", None, "", "+1 415 555 0000 or 4111111111111111"])).collect()}
    assert rows == {0: "é [EMAIL], [IP]!", 1: None, 2: "", 3: "[PHONE] or [CARD]"}


def test_overlapping_spans_make_one_tag(documents):
    assert pii.redact(documents(["+4111111111111111"])).first().text in ("+[CARD]", "[PHONE]")


def test_empty_table_and_columns(spark, documents):
    docs = documents([]) 
    assert pii.find_pii(docs).count() == 0
    assert pii.redact(docs).columns == docs.columns


def redacted(text, spans):
    out, pos = "", 0
    for s in sorted(spans, key=lambda s: (s.start, s.end, s.kind)):
        if s.start >= pos:
            out += text[pos:s.start] + f"[{s.kind.upper()}]"
        pos = max(pos, s.end)
    return out + text[pos:]


def mixed(words, n):
    parts = ["a.b@c.de", "1.2.3.4", "4111 1111 1111 1111", "+1 415 555 0000", "ssn", "123-45-6789", "GB82 WEST 1234 5698 7654 32", "é😀", "call", "+4111111111111111",
             "1.2.3.4@x.yz", "token=24be64439e3e49cf46b2", "mail"]
    return " ".join(words.random.choice(parts) if words.random.random() < 0.7 else words.word() for _ in range(n))


def test_blocks_change_nothing(documents, words, monkeypatch):
    """Spans, scores and redaction with blocks of 2 matches, of 256, and by plain Python."""
    texts = [mixed(words, n) for n in (1, 2, 3, 5, 8, 40, 300)] + ["x@y.z" * 3 + " ", "123-45-6789 " * 9]
    seen = []
    for size in (256, 2):
        monkeypatch.setattr(pii, "BLOCK", size)
        seen.append({r.doc_id: r.pii for r in pii.find_pii(documents(texts)).collect()})
    assert seen[0] == seen[1]
    for i, text in enumerate(texts):
        for s in seen[0][i]:
            near = text[max(0, s.start - pii.CONTEXT_CHARS):s.start].lower()
            gain = pii.CONTEXT_GAIN if re.search(pii.CONTEXT[s.kind], near) else 0.0
            assert s.score == pii.SCORES[s.kind] + gain
    clean = {r.doc_id: r.text for r in pii.redact(documents(texts)).collect()}
    assert clean == {i: redacted(t, seen[0][i]) for i, t in enumerate(texts)}


def test_account_number_before_capitals(documents):
    texts = ["ES91 2100 0418 4502 0005 1332 EUR", "GB82 WEST 1234 5698 7654 32 ABC 123", "GB82WEST12345698765432 EUR", "ES91 2100 0418 4502 0005 1333 EUR"]
    rows = pii.find_pii(documents(texts)).orderBy("doc_id").collect()
    assert [[t[s.start:s.end] for s in r.pii if s.kind == "iban"] for t, r in zip(texts, rows)] == [
        ["ES91 2100 0418 4502 0005 1332"], ["GB82 WEST 1234 5698 7654 32"], ["GB82WEST12345698765432"], []]
    assert pii.redact(documents(texts[:1])).first().text == "[IBAN] EUR"


def test_time_grows_with_the_matches(documents):
    """50,000 addresses in one text: found and redacted in seconds."""
    text = "".join(f"name{i}@mail{i % 7}.org, " for i in range(50_000))
    began = time.monotonic()
    row = pii.find_pii(documents([text])).select(F.size("pii").alias("n"), F.element_at("pii", -1).alias("last")).first()
    assert row.n == 50_000 and text[row["last"].start:row["last"].end] == "name49999@mail5.org" and row["last"].score == 0.9 + pii.CONTEXT_GAIN
    clean = pii.redact(documents([text])).first().text
    assert clean == "[EMAIL], " * 50_000
    assert time.monotonic() - began < 60
