"""Personal data by patterns, checksums and context words, in DataFrame expressions only."""

from pyspark.sql import functions as F

# The patterns of the base kinds, in the order of kinds. They match what the plain patterns match
# (leftmost, non-overlapping, longest runs) but never try a run again from its middle, so time stays linear:
#   email [A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+
#   ip    [0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)
#   card  [0-9]([\x20-]?[0-9])+
#   phone \+[0-9][\x20().0-9-]+[0-9]
EMAIL = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?[0-9]){12,18}+(?![\x20-]?[0-9])"  # 13 to 19 digits in all
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
# Added by the method.
# Lengths of IBANs by country (the ISO 13616 registry, and countries in use outside it). A match ends where its country's length is reached.
IBAN_LENGTHS = {
    15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH HR LI LV",
    22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG",
    25: "AO CV GW LY MZ PT ST", 26: "DZ IR IS TR", 27: "BI CF CG CM DJ FR GA GQ GR IT KM MC MG SM TD",
    28: "AL AZ BF BJ BY CI CY DO GT HN HU LB MA ML NE NI PL SN SV TG",
    29: "BR EG PS QA UA", 30: "JO KW MU YE", 31: "MT SC", 32: "LC", 33: "RU",
}
IBAN = r"(?<![A-Za-z0-9])(?=[A-Z]{2}[0-9]{2})(?:%s)(?![A-Za-z0-9])" % "|".join(
    r"(?:%s)[0-9]{2}(?:\x20?[A-Z0-9]){%d}" % (c.replace(" ", "|"), n - 4) for n, c in IBAN_LENGTHS.items()
)
NATIONAL_ID = r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])"

BYTE_PART = r"^0*+(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[0-9]{1,2}|)$"

BASE_KINDS = ("email", "ip", "card", "phone")

# Scores: a kind's own, what a passed checksum adds, what a context word nearby adds. Spans of the base kinds
# stay whatever their score; the others need THRESHOLD.
SCORE = {"email": 0.8, "ip": 0.5, "card": 0.3, "phone": 0.5, "iban": 0.3, "id": 0.3, "card_short": 0.1}
CHECKED, CONTEXT, THRESHOLD = 0.35, 0.25, 0.5
WORDS = {
    "email": "mail|e-mail|contact|kontakt|correo", "ip": "ip|address|host|server", "card": "card|visa|credit|payment|karte|carte|tarjeta",
    "phone": "phone|tel|call|mobile|fax", "iban": "iban|account|bank|konto|compte|cuenta", "id": "ssn|social|security|id", "card_short": "card|amex|credit|payment|karte|carte|tarjeta",
}
WINDOW = 48

_BLOCK = 128


def let(value, body):
    """`body` of a value that is computed once."""
    return F.transform(F.array(value), body)[0]


def _running(sizes):
    """Sums of the elements before each one; for short arrays."""
    zero = F.struct(F.array().cast("array<bigint>").alias("out"), F.lit(0).cast("bigint").alias("sum"))
    return F.aggregate(sizes, zero, lambda a, x: F.struct(
        F.concat(a["out"], F.array(a["sum"])).alias("out"), (a["sum"] + x).alias("sum")
    ), lambda a: a["out"])


def _total(sizes):
    return F.aggregate(sizes, F.lit(0).cast("bigint"), lambda a, x: a + x)


def prefix_sums(sizes):
    """Sums of the elements before each one, block by block, as building an array copies it."""
    def inside(sizes):
        last = F.floor((F.size(sizes) - 1) / _BLOCK).cast("int")
        blocks = F.transform(F.sequence(F.lit(0), last), lambda b: F.slice(sizes, b * _BLOCK + 1, F.lit(_BLOCK)))
        return let(blocks, lambda bs: F.flatten(F.zip_with(
            bs, _running(F.transform(bs, _total)), lambda b, lead: F.transform(_running(b), lambda x: x + lead)
        )))

    return let(sizes, inside)


def matches(text, pattern, kind, valid, gate=None):
    """Array of (kind, start, end, checked, near): the valid matches of a pattern. Code points, end exclusive.

    `valid` takes the match to a boolean or (valid, checked) pair; near tells if a context word is within WINDOW.
    """
    none = F.array().cast("array<struct<kind:string,start:bigint,end:bigint,checked:boolean,near:boolean>>")
    near = rf"(?i)\b(?:{WORDS[kind]})\b"

    def located(found):
        def placed(parts):
            sizes = F.transform(found, lambda m, i: (F.length(m) + F.length(parts[i])).cast("bigint"))
            return let(prefix_sums(sizes), lambda lead: F.filter(F.transform(found, lambda m, i: F.struct(
                F.lit(kind).alias("kind"),
                (lead[i] + F.length(parts[i])).alias("start"),
                (lead[i] + F.length(parts[i]) + F.length(m)).alias("end"),
                valid(m).alias("checked"),
                (F.right(parts[i], F.lit(WINDOW)).rlike(near) | F.left(parts[i + 1], F.lit(WINDOW)).rlike(near)).alias("near"),
            )), lambda s: s["checked"].isNotNull()))

        return F.when(F.size(found) == 0, none).otherwise(let(F.split(text, pattern, -1), placed))

    found = let(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), located)
    return found if gate is None else F.when(gate, found).otherwise(none)


def digits(match):
    return F.regexp_replace(match, r"[^0-9]", "")


def _passes(condition, checked=False):
    """`checked` where a condition holds, else null."""
    return F.when(condition, F.lit(checked))


def luhn(number):
    """Whether a string of digits has a valid Luhn check digit."""
    def odd_one(d, i):
        twice = d.cast("int") * (1 + F.pmod(i, F.lit(2)))
        return twice - F.when(twice > 9, 9).otherwise(0)

    backwards = F.filter(F.split(F.reverse(number), ""), lambda d: d != "")
    return F.aggregate(F.transform(backwards, odd_one), F.lit(0), lambda a, d: a + d) % 10 == 0


def mod97(iban):
    """Whether an IBAN without spaces has valid check digits: the first four characters last, letters as 10 to 35, modulo 97."""
    turned = F.concat(F.substring(iban, 5, 40), F.substring(iban, 1, 4))
    values = F.transform(F.filter(F.split(turned, ""), lambda c: c != ""), lambda c: F.when(
        c >= "A", F.ascii(c) - 55
    ).otherwise(F.ascii(c) - 48))
    return F.aggregate(values, F.lit(0), lambda a, v: (a * F.when(v > 9, 100).otherwise(10) + v) % 97) == 1


def spans(text):
    """Array of (kind, start, end, score) of all personal data in a text column, by kind as listed, then start.

    Kinds: the base kinds, then iban (modulo 97 must hold), id (three, two and four digits) and card_short (13 to 15 digits
    that pass Luhn); those need the threshold, which id and card_short reach only with a context word nearby.
    """
    text = F.coalesce(text, F.lit(""))
    count = lambda m: F.length(digits(m))

    def ip(m):
        return _passes(F.forall(F.split(m, r"\."), lambda part: part.rlike(BYTE_PART)))

    def card(low, high):
        return lambda m: let(digits(m), lambda d: _passes(
            F.length(d).between(low, high) & F.when(F.length(d).between(low, high), luhn(d)).otherwise(False), True
        ))

    def national(m):
        return _passes(~m.rlike(r"^(?:000|666|9..)|-00-|-0000$"))

    plus, at = F.instr(text, "+") > 0, F.instr(text, "@") > 0
    found = [
        matches(text, EMAIL, "email", lambda m: _passes(F.lit(True)), at),
        matches(text, IP, "ip", ip),
        matches(text, CARD, "card", card(16, 19)),
        matches(text, PHONE, "phone", lambda m: _passes(count(m).between(8, 15)), plus),
        matches(text, IBAN, "iban", lambda m: let(F.replace(m, F.lit(" "), F.lit("")), lambda d: _passes(mod97(d), True))),
        matches(text, NATIONAL_ID, "id", national),
        matches(text, CARD, "card_short", card(13, 15)),
    ]
    own = F.create_map(*[F.lit(x) for pair in SCORE.items() for x in pair])
    rated = F.transform(F.concat(*found), lambda s: F.struct(
        s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end"),
        F.least(F.lit(1.0), own[s["kind"]] + F.when(s["checked"], CHECKED).otherwise(0.0) + F.when(s["near"], CONTEXT).otherwise(0.0)).alias("score"),
    ))
    return F.filter(rated, lambda s: s["kind"].isin(*BASE_KINDS) | (s["score"] >= THRESHOLD))


def find_pii(docs, keep=("doc_id",), text="text"):
    """Rows (keep..., spans array<struct<kind, start, end, score>>), one for each document row.

    Null and empty texts have no spans; repeated rows are treated one by one; other columns play no part.
    """
    return docs.select(*[F.col(f"`{k}`") for k in keep], spans(F.col(f"`{text}`")).alias("spans"))


def redact(text, found):
    """A text column with each span replaced by its kind in angle brackets; of overlapping spans the first (longest) counts."""
    ordered = F.array_sort(found, lambda a, b: F.when(
        a["start"] != b["start"], F.when(a["start"] < b["start"], -1).otherwise(1)
    ).otherwise(F.when(a["end"] > b["end"], -1).when(a["end"] < b["end"], 1).otherwise(0)))
    zero = F.struct(F.lit("").alias("out"), F.lit(0).cast("bigint").alias("at"))
    return F.aggregate(ordered, zero, lambda a, s: F.when(s["start"] < a["at"], a).otherwise(F.struct(
        F.concat(a["out"], F.substring(text, (a["at"] + 1).cast("int"), (s["start"] - a["at"]).cast("int")), F.lit("<"), s["kind"], F.lit(">")).alias("out"),
        s["end"].alias("at"),
    )), lambda a: F.concat(a["out"], F.substring(text, (a["at"] + 1).cast("int"), F.length(text))))
