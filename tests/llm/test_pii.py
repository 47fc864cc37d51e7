import re

from pyspark.sql import functions as F

from sessionrank.llm import pii

from .texts import documents

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(number):
    twice = [int(c) * (1 + i % 2) for i, c in enumerate(reversed(number))]
    return sum(x - 9 * (x > 9) for x in twice) % 10 == 0


def base(text):
    out = []
    for kind, pattern in PATTERNS.items():
        for m in re.finditer(pattern, text or ""):
            d = re.sub("[^0-9]", "", m[0])
            good = {
                "email": True, "ip": all(int(x) <= 255 for x in m[0].split(".")) if kind == "ip" else False,
                "card": 16 <= len(d) <= 19 and luhn(d), "phone": 8 <= len(d) <= 15,
            }[kind]
            if good:
                out.append((kind, m.start(), m.end()))
    return out


CASES = [
    "mail a.b@c-d.org, a@b.c_d@e.f a@@b.c x@y z%+-@q.w.e. no@dot", "1.2.3.400.5.6.7.8 1.2.3.4.5.6.7.8 0001.02.3.4 256.1.1.1 1.2.3 .1.2.3.4.",
    "4041894974608795 4041-8949 7460-8795 40418949746087950 4041894974608796 1234 5678 9012 3456 7890 1", "+1 (456) 555-2186 +12 +1--------2 ++49 30 1234567 +1234567890123456 +1 2(((",
    "😀 é 4041894974608795 😀 192.168.0.1 😀 x@y.zz", "call +1 (724) 555-7058 or 4 0 4 1 8 9 4 9 7 4 6 0 8 7 9 5", None, "", "\n\n", "a" * 20000 + "@", "1" * 20000, "+1" + "(" * 5000,
    "1.2.3.4 " * 700 + "a@b.cc " * 300, "ab@cd.ef." * 200, "4041894974608795-" * 4,
]


def test_base_spans_equal_the_plain_patterns(spark):
    found = pii.find_pii(documents(spark, CASES)).collect()
    for r in found:
        got = [(s["kind"], s["start"], s["end"]) for s in r["spans"] if s["kind"] in pii.BASE_KINDS]
        assert got == base(CASES[r["doc_id"]]), CASES[r["doc_id"]]


def test_checksums_and_context(spark):
    texts = [
        "IBAN DE89 3704 0044 0532 0130 00 here", "GB82WEST12345698765432", "DE89370400440532013001", "my ssn is 123-45-6789",
        "part 123-45-6789 of it", "ssn 000-45-6789", "amex card 378282246310005", "serial 378282246310005",
    ]
    found = pii.find_pii(documents(spark, texts)).collect()
    kinds = {r["doc_id"]: [s["kind"] for s in r["spans"]] for r in found}
    assert kinds == {0: ["iban"], 1: ["iban"], 2: [], 3: ["id"], 4: [], 5: [], 6: ["card_short"], 7: []}
    # Context words are whole words.
    loose = pii.find_pii(documents(spark, ["a good idea 123-45-6789", "ID: 123-45-6789"])).orderBy("doc_id").collect()
    assert [len(r["spans"]) for r in loose] == [0, 1]
    near = pii.find_pii(documents(spark, ["visa card 4041894974608795", "4041894974608795"])).collect()
    assert near[0]["spans"][0]["score"] > near[1]["spans"][0]["score"]


def test_redaction_and_empty_table(spark):
    docs = documents(spark, ["to a@b.cc and 1.2.3.4!", "none", None])
    out = docs.select(pii.redact(F.coalesce("text", F.lit("")), pii.spans(F.col("text"))).alias("t"))
    assert [r["t"] for r in out.collect()] == ["to <email> and <ip>!", "none", ""]
    assert pii.find_pii(docs.limit(0)).collect() == []


def test_prefix_sums_in_blocks(spark):
    row = spark.range(1).select(
        pii.prefix_sums(F.sequence(F.lit(1).cast("bigint"), F.lit(1000).cast("bigint"))).alias("p"),
    ).first()
    assert row["p"] == [k * (k + 1) // 2 for k in range(1000)]


def iban(country, account):
    """With valid check digits."""
    turned = "".join(str(int(c, 36)) for c in account + country + "00")
    return f"{country}{98 - int(turned) % 97:02d}{account}"


def test_ibans_end_at_their_country_s_length(spark):
    good = ["GB82WEST12345698765432", "GB82 WEST 1234 5698 7654 32", "DE89370400440532013000", "NO93 8601 1117 947"]
    good += [iban(c, "1" * (n - 4)) for n, cs in pii.IBAN_LENGTHS.items() for c in cs.split()]
    after = ["", " Please pay", " 2024", " BIC COBADEFF", ", X", " A1 B2", " " + good[2]]
    cases = [(f"To {g}{a}", g, a) for g in good for a in after]
    texts = [t for t, _, _ in cases] + ["To DE89370400440532013000X", "To DE8937040044053201300", "xDE89370400440532013000", "QQ89370400440532013000"]
    for r in pii.find_pii(documents(spark, texts)).collect():
        got = [(s["start"], s["end"]) for s in r["spans"] if s["kind"] == "iban"]
        if r["doc_id"] < len(cases):
            text, g, a = cases[r["doc_id"]]
            assert got[:1] == [(3, 3 + len(g))] and len(got) == 1 + (a == after[-1]), text
        else:
            assert got == []
