import hashlib
import re

from ledgerloom.llm import private_spans


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        v = int(c) * (1 + i % 2)
        total += v - 9 * (v > 9)
    return total % 10 == 0


def base(t):
    """The base spans as Python's re finds them: (start, kind, end)."""
    out = [(m.start(), 0, m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", t)]
    out += [(m.start(), 1, m.end()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", t) if all(int(x) <= 255 for x in m[0].split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", t):
        digits = re.sub("[^0-9]", "", m[0])
        if 12 <= len(digits) <= 19 and luhn(digits):
            out.append((m.start(), 2, m.end()))
    out += [(m.start(), 3, m.end()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", t) if 9 <= len(re.sub("[^0-9]", "", m[0])) <= 15]
    return sorted(out)


TEXTS = [
    None, "", "a@b.c_d@e.f g@h", "x%y@a-b.co.uk.", "@a.b c@.d e@f..g", "1.2.3.4.5.6.7.8 256.1.1.1 1.2.3 00000255.0.0.1", "9" * 40 + ".1.2.3", "4539 1488 0343 6467", "4539-1488 03436467, 45391488034364671",
    "4539  1488", "0 0 0 0 0 0 0 0 0 0 0 0 0", "+1 (555) 123-4567 +12 +1 2", "+1234567890123456 +1 555.123.4567.", "é\U0001f600 ü a@b.c \x01 d@e.f\x01", "\x01a@b.c", "1" * 20000, "1 " * 9000, "a." * 9000 + "@", "a@" + "b." * 9000,
    "+" + "1-" * 9000, "1." * 9000, "+1 (4111) 1111-1111 1111 1",
]


def test_base_spans_like_plain_regular_expressions(spark):
    docs = spark.createDataFrame([(i, t, 1) for i, t in enumerate(TEXTS)], "doc_id bigint, text string, spans int")
    names = private_spans.KINDS
    for r in private_spans.find(docs).collect():
        want = base(TEXTS[r["doc_id"]] or "")
        text = ",".join(f"{names[k]}:{a}:{b}" for a, k, b in want)
        assert r["base_sha256"] == hashlib.sha256(text.encode()).hexdigest(), (r["doc_id"], r["spans"], text)
        assert [r["n_email"], r["n_ip"], r["n_card"], r["n_phone"]] == [sum(k == i for _, k, _ in want) for i in range(4)]


def test_contexts_find_what_patterns_miss(spark, odd, none):
    known = [f"please wire to account 4539 1488 0343 6467 today number {i}" if i % 2 else f"client id {i} reach him at mail{i}@host.example.com please" for i in range(30)]
    # distinct seeds in one context, then identifiers of that context which no base pattern takes
    cards = ["4539148803436467", "4111111111111111", "5500005555555559", "340000000000009"]
    texts = known + [f"the member card {c} was seen" for c in cards] + ["the member card 123-456-789 was seen", "some other words 987-654-321 stay", "reach him at operator@localhost please"]
    others = ["the member card ZX-81-Q7 was seen", "the member card user_77, was seen", "our product ZX-81-Q7X is here", "the member card plainword was seen"]
    docs = spark.createDataFrame(list(enumerate(others + texts)), "doc_id bigint, text string")
    rows = {r["doc_id"]: r["spans"] for r in private_spans.find(docs).collect()}
    n = len(texts) + len(others)
    assert [rows[i] for i in range(4)] == ["context:16:24", "context:16:23", "", ""]
    assert rows[n - 3] == "context:16:27" and rows[n - 2] == "" and rows[n - 1].startswith("context:13:")
    assert private_spans.find(odd).count() == odd.count() and private_spans.find(none).count() == 0


def test_redaction(spark, odd, none):
    rows = [(1, "to a@b.c and +1 (555) 123-4567!", 31), (2, None, None), (3, "plain", 5), (1, "to a@b.c and +1 (555) 123-4567!", 31)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, n_chars bigint")
    got = sorted(map(tuple, private_spans.redact(docs).collect()), key=str)
    assert got == sorted([(1, "to <EMAIL> and <PHONE>!", 23), (1, "to <EMAIL> and <PHONE>!", 23), (2, None, None), (3, "plain", 5)], key=str)
    assert private_spans.redact(odd).columns == odd.columns and private_spans.redact(odd).count() == odd.count() and private_spans.redact(none).count() == 0
