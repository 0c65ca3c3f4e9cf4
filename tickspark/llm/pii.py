"""Personal data: regular expressions propose spans, checksums confirm them, nearby words adjust the score.

``find_pii`` takes any frame with a text column and adds ``spans``, an array of
``(start, rank, kind, end, score, base, found)`` in code points (end exclusive),
by start and then kind.  Everything is a column expression of one row: no
shuffle, no Python worker, and a lost executor costs a re-read of its files.

The base kinds (``email``, ``ip``, ``card``, ``phone``) stay whatever their score.
The method adds, where the score reaches ``ACCEPTED``:

* ``card`` inside a run of digits that is no card as a whole: numbers of 14 to 19
  digits, or four groups of four, that pass Luhn;
* ``iban``: country and length as registered, mod 97 equal to 1;
* ``ssn``: three, two and four digits of an issued range; needs a context word.

A span's score starts at its kind's value and moves by ``CONTEXT`` where a word
for or against it stands in the 48 code points before it or the 24 after it (at
most up to the neighbouring match of its kind).

Null and empty texts have an empty array.  A null id, repeated rows and further
columns pass through; a column called ``spans`` is replaced.  Ties (several kinds
from one place) are ordered by kind and end.  An empty table gives no rows.
Time and memory are linear in the length of a text: the patterns start at the
first character of a run only, take runs without backtracking, and positions
are sums of lengths taken in blocks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickspark.llm.common import let, read_table, text_or_empty

#: Kinds in the order in which they are listed.
KINDS = ["email", "ip", "card", "phone", "iban", "ssn"]
#: Score of a confirmed span without context, by kind ("grouped": a card in groups inside a longer run).
SCORES = {"email": 0.9, "ip": 0.6, "card": 0.8, "phone": 0.7, "iban": 0.8, "ssn": 0.3, "inner": 0.6, "grouped": 0.4}
CONTEXT = 0.2
ACCEPTED = 0.5
BEFORE, AFTER = 48, 24
#: Lengths are added up in blocks of this many matches.
BLOCK = 128

# Context words for and against a kind.
WORDS_FOR = {
    "email": "e-?mail|mail|contact|address|write to|reach",
    "ip": "ip|host|server|client|address|addr|ping|login",
    "card": "card|visa|mastercard|amex|credit|debit|payment|account|cvv|expires?",
    "phone": "phone|tel|telephone|call|mobile|cell|fax|contact|dial",
    "iban": "iban|bank|account|transfer|swift|bic",
    "ssn": "ssn|social security|tax id|taxpayer",
}
WORDS_AGAINST = {
    "email": "example only|placeholder",
    "ip": "version|release|build|section|chapter",
    "card": "order|invoice|isbn|tracking|serial|barcode",
    "phone": "order|invoice|serial|part number",
    "iban": "serial|part number",
    "ssn": "order|invoice|part|serial|sku",
}

# Registered IBAN lengths by country.
IBAN_LENGTHS = {
    "AD": 24, "AE": 23, "AL": 28, "AT": 20, "AZ": 28, "BA": 20, "BE": 16, "BG": 22, "BH": 22, "BR": 29, "BY": 28,
    "CH": 21, "CR": 22, "CY": 28, "CZ": 24, "DE": 22, "DK": 18, "DO": 28, "EE": 20, "EG": 29, "ES": 24, "FI": 18,
    "FO": 18, "FR": 27, "GB": 22, "GE": 22, "GI": 23, "GL": 18, "GR": 27, "GT": 28, "HR": 21, "HU": 28, "IE": 22,
    "IL": 23, "IQ": 23, "IS": 26, "IT": 27, "JO": 30, "KW": 30, "KZ": 20, "LB": 28, "LI": 21, "LT": 20, "LU": 20,
    "LV": 21, "MC": 27, "MD": 24, "ME": 22, "MK": 19, "MR": 27, "MT": 31, "MU": 30, "NL": 18, "NO": 15, "PK": 24,
    "PL": 28, "PS": 29, "PT": 25, "QA": 29, "RO": 24, "RS": 22, "SA": 24, "SC": 31, "SE": 24, "SI": 19, "SK": 24,
    "SM": 27, "TN": 24, "TR": 26, "UA": 29, "VA": 22, "VG": 24, "XK": 20,
}

# The base patterns find what the contract's do: a match starts where its run starts (or where the last match
# ended), since a later start in the same run fails or succeeds together with the first; runs are possessive.
_LOCAL = "[A-Za-z0-9._%+-]"
EMAIL = rf"(?:\G|(?<!{_LOCAL})){_LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
# of the runs of digits with single separators, those of 14 digits and more
CARD = r"[0-9](?:[\x20-]?[0-9]){13,}+"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
IBAN = r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?(?![A-Za-z0-9])"
SSN = r"(?<![0-9+.-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])"
INNER_CARD = r"(?<![0-9])(?:[0-9]{14,19}|[0-9]{4}([\x20-])[0-9]{4}\1[0-9]{4}\1[0-9]{4})(?![0-9])"


def _total(xs: Column) -> Column:
    return F.aggregate(xs, F.lit(0).cast("long"), lambda a, x: a + x)


def _sums_before(steps: Column) -> Column:
    """For every element the sum of those before it; each is read about ``BLOCK`` times, not once per element."""
    last = lambda xs: (F.size(xs) - 1).cast("int")
    block = lambda i: F.floor(i / BLOCK).cast("int")

    def with_blocks(xs: Column) -> Column:
        sums = F.transform(F.sequence(F.lit(0), block(last(xs))), lambda b: _total(F.slice(xs, b * BLOCK + 1, BLOCK)))
        return let(sums, lambda s: let(
            F.transform(s, lambda _, b: _total(F.slice(s, F.lit(1), b))),
            lambda before: F.transform(xs, lambda _, i: F.get(before, block(i)) + _total(
                F.slice(xs, i - i % BLOCK + 1, i % BLOCK)))))

    return let(steps, with_blocks)


def _located(text: Column, pattern: str, gate: Column | None = None) -> Column:
    """``array<struct<found, start, near>>`` of the pattern's matches: what lies between the matches
    (``split``) and the matches themselves add up to the places."""
    none = F.expr("cast(array() as array<struct<found: string, start: bigint, near: string>>)")
    piece = lambda p: F.struct(F.length(p).cast("long").alias("size"), F.substring(p, -BEFORE, BEFORE).alias("tail"),
                               F.substring(p, 1, AFTER).alias("head"))

    def places(m: Column) -> Column:
        return F.when(F.size(m) == 0, none).otherwise(let(
            F.transform(F.split(text, pattern, -1), piece),
            lambda g: let(
                _sums_before(F.transform(m, lambda s, i: F.length(s) + F.get(g, i)["size"])),
                lambda before: F.transform(m, lambda s, i: F.struct(
                    s.alias("found"), (F.get(before, i) + F.get(g, i)["size"]).alias("start"),
                    F.concat(F.get(g, i)["tail"], F.lit(" "), F.get(g, i + 1)["head"]).alias("near"))))))

    found = let(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), places)
    return found if gate is None else F.when(gate, found).otherwise(none)


def digits_of(found: Column) -> Column:
    return F.regexp_replace(found, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether the Luhn sum of a string of digits is a multiple of ten."""
    def term(i: Column) -> Column:
        d = F.substring(digits, -i, F.lit(1)).cast("int") * F.when(i % 2 == 0, 2).otherwise(1)
        return F.when(d > 9, d - 9).otherwise(d)
    return F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), lambda a, i: a + term(i)) % 10 == 0


def mod97(code: Column) -> Column:
    """An IBAN's check: its first four characters moved to the end, letters as 10 to 35, modulo 97."""
    turned = F.concat(F.substring(code, 5, 64), F.substring(code, 1, 4))

    def step(a: Column, c: Column) -> Column:
        return F.when(c.between("0", "9"), a * 10 + c.cast("int")).otherwise(a * 100 + F.ascii(c) - 55) % 97
    return F.aggregate(F.split(turned, ""), F.lit(0), step)


def _valid_ip(found: Column) -> Column:
    # as text: a part of any length, zeros in front, is at most 255
    return F.forall(F.split(found, r"\."), lambda p: let(F.regexp_replace(p, "^0+(?=[0-9])", ""), lambda q: (
        (F.length(q) < 3) | ((F.length(q) == 3) & (q <= "255")))))


def _valid_card(found: Column) -> Column:
    return let(digits_of(found), lambda d: F.when(F.length(d).between(14, 19), luhn(d)).otherwise(F.lit(False)))


def _valid_phone(found: Column) -> Column:
    return F.length(digits_of(found)).between(10, 15)


def _valid_iban(found: Column) -> Column:
    lengths = F.create_map(*[F.lit(v) for pair in IBAN_LENGTHS.items() for v in pair])
    return let(F.replace(found, F.lit(" "), F.lit("")), lambda c: F.when(
        F.length(c) == F.try_element_at(lengths, F.substring(c, 1, 2)), mod97(c) == 1).otherwise(F.lit(False)))


def _valid_ssn(found: Column) -> Column:
    area, group, serial = F.substring(found, 1, 3), F.substring(found, 5, 2), F.substring(found, 8, 4)
    return (area != "000") & (area != "666") & (area < "900") & (group != "00") & (serial != "0000")


VALID = {"email": lambda _: F.lit(True), "ip": _valid_ip, "card": _valid_card, "phone": _valid_phone,
         "iban": _valid_iban, "ssn": _valid_ssn}


def _scored(kind: str, near: Column, start: float | Column) -> Column:
    word = lambda words: F.when(near.rlike(rf"(?i)\b(?:{words})\b"), CONTEXT).otherwise(0.0)
    moved = F.lit(start) if isinstance(start, float) else start
    moved = moved + word(WORDS_FOR[kind]) - word(WORDS_AGAINST[kind])
    return F.round(F.greatest(F.lit(0.0), F.least(F.lit(1.0), moved)), 2)


def _span(kind: str, at: Column, score: Column, base: bool) -> Column:
    return F.struct(at["start"].alias("start"), F.lit(KINDS.index(kind)).alias("rank"), F.lit(kind).alias("kind"),
                    (at["start"] + F.length(at["found"])).alias("end"), score.alias("score"),
                    F.lit(base).alias("base"), at["found"].alias("found"))


def _confirmed(kind: str, proposed: Column, base: bool) -> Column:
    kept = F.filter(proposed, lambda p: VALID[kind](p["found"]))
    spans = F.transform(kept, lambda p: _span(kind, p, _scored(kind, p["near"], SCORES[kind]), base))
    return spans if base else F.filter(spans, lambda s: s["score"] >= ACCEPTED)


def _inner_cards(runs: Column) -> Column:
    """Cards inside the runs of digits that are no card as a whole."""
    def inside(run: Column) -> Column:
        valid = F.filter(_located(run["found"], INNER_CARD), lambda c: _valid_card(c["found"]))
        solid = lambda found: F.when(found.rlike("^[3-6][0-9]+$"), SCORES["inner"]).otherwise(SCORES["grouped"])
        return F.transform(valid, lambda c: let(
            F.struct(c["found"].alias("found"), (run["start"] + c["start"]).alias("start")),
            lambda at: _span("card", at, _scored("card", run["near"], solid(c["found"])), False)))

    failed = F.filter(runs, lambda r: ~_valid_card(r["found"]))
    return F.filter(F.flatten(F.transform(failed, inside)), lambda s: s["score"] >= ACCEPTED)


def find_pii(df: DataFrame, text: str = "text") -> DataFrame:
    """``df`` with ``spans``: confirmed personal data of each row's whole text (see the module's text)."""
    t = text_or_empty(f"`{text}`")
    digit = t.rlike("[0-9]")
    proposed = {
        "email": _located(t, EMAIL, F.contains(t, F.lit("@"))),
        "ip": _located(t, IP, digit),
        "phone": _located(t, PHONE, F.contains(t, F.lit("+"))),
        "iban": _located(t, IBAN, digit),
        "ssn": _located(t, SSN, digit & F.contains(t, F.lit("-"))),
    }
    parts = [_confirmed(kind, found, kind in KINDS[:4]) for kind, found in proposed.items()]
    # the runs of digits are looked at twice: as a whole, and from inside
    cards = let(_located(t, CARD, digit), lambda runs: F.concat(_confirmed("card", runs, True), _inner_cards(runs)))
    return df.withColumn("spans", F.array_sort(F.concat(*parts, cards)))


def op13_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data of every whole text of ``documents``: base counts and digest, all spans, their scores."""
    found = find_pii(read_table(spark, sf_dir, "documents").select("doc_id", "text")).drop("text")
    place = lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))
    base = F.filter("spans", lambda s: s["base"])
    count = lambda kind: F.size(F.filter("spans", lambda s: s["base"] & (s["kind"] == kind))).cast("long")
    return found.select(
        "doc_id", *[count(kind).alias(f"n_{kind}") for kind in KINDS[:4]],
        F.sha2(F.array_join(F.transform(base, place), ",").cast("binary"), 256).alias("base_sha256"),
        F.array_join(F.transform("spans", place), ",").alias("spans"),
        F.array_join(F.transform("spans", lambda s: s["score"].cast("string")), ",").alias("scores"))
