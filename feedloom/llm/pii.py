"""Personal data as format-preserving pseudonyms, by DataFrame functions only.

E-mail and IP addresses, payment card numbers, phone numbers, social security numbers and dates are found
by one pattern, validated, and replaced by a keyed permutation *within their format*: a number stays a
valid number, a date a date, separators stay where they are. Equal values have equal pseudonyms in all
documents, different values have different ones, and the holder of the key can undo them (``undo``).

A number is a pair (x, y) with x below a and y below b; a Feistel round adds, modulo a or b, a keyed SHA-256
of one half to the other. Each kind has its pair of moduli:

* card: all digits but the last, cut in two; the last one is the check digit, computed anew (Luhn).
* phone: the digits after the country code, cut in two.
* IP address: two times 16 bits. Social security number: valid area and group, and serial number.
* date: the day's number from 1900-01-01 to 2099-12-31, as 17 x 4297.
* e-mail address: letters and digits, but for the top-level domain, are shifted within their alphabet (a-z, A-Z, 0-9,
  accented Latin, Cyrillic, Greek) by a keyed hash of the other half of the signs. Other scripts' letters stay.

The key is an argument: whoever has it can undo the result. Work grows with the length of a text, however many values or
dots it has.

What fails validation (a card number with a wrong check digit, 31 February) is not personal data here and
stays. Defined results: null text stays null, empty text empty; repeated rows each get a row; other columns
stay as they are.
"""

from __future__ import annotations

import secrets

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from feedloom.llm.native import gaps_and_matches, joined_spans, spans_of_pairs

KINDS = ("email", "ip", "card", "phone", "ssn", "date")
ROUNDS = 8
#: The session setting that holds the key of ``session_key``.
KEY_SETTING = "spark.feedloom.pii.key"

_EMAIL = r"(?<![\p{L}\p{N}._%+-])[\p{L}\p{N}._%+-]++@[\p{L}\p{N}-]++(?:\.[\p{L}\p{N}-]++)++"
_IP = r"(?<![\p{L}\d.])(?:\d{1,3}\.){3}\d{1,3}(?![\p{L}\d]|\.\d)"
_DATE = r"(?<![\p{L}\d])(?:(?:19|20)\d\d-\d\d-\d\d|\d\d([./])\d\d\1(?:19|20)\d\d)(?![\p{L}\d])"
_SSN = r"(?<![\p{L}\d-])\d{3}-\d\d-\d{4}(?![\p{L}\d-])"
_PHONE = (
    r"(?<![\p{L}\d+])(?:\+\d{1,3}[ .-]?\(\d{2,4}\)[ .-]?\d{3}[ .-]?\d{4}|\+\d{1,3}(?:[ .-](?!(?:19|20)\d\d-\d\d-\d\d|\d\d[./]\d\d[./](?:19|20))\d{2,4}){2,4}"
    r"|\+\d{8,15}|\(\d{3}\) ?\d{3}[ .-]\d{4}|\d{3}([.-])\d{3}\2\d{4})"
    r"(?![\p{L}\d]|\.\d)"
)
_CARD = r"(?<![\p{L}\d])(?:\d{13,19}|\d{4}([ -])\d{4}\3\d{4}\3\d{4}|\d{4}([ -])\d{6}\4\d{5})(?![\p{L}\d])"
PATTERN = "|".join((_EMAIL, _IP, _DATE, _SSN, _PHONE, _CARD))


def _letters(first: str, last: str, but: str = "") -> str:
    return "".join(c for c in map(chr, range(ord(first), ord(last) + 1)) if c not in but)


#: Letters and digits of e-mail addresses move within their alphabet: Latin, its accented letters, Cyrillic, Greek.
ALPHABETS = (
    _letters("a", "z"), _letters("A", "Z"), _letters("0", "9"), _letters("à", "ÿ", "÷"), _letters("À", "Þ", "×"),
    _letters("а", "я"), _letters("А", "Я"), _letters("α", "ω"), _letters("Α", "Ω", "\u03a2"),
)

_FIRST_DAY, _DAYS = "1900-01-01", (17, 4297)
_SSN_AREAS = 898  # 001 to 899 but 666
_IP_FORM = r"^\d{1,3}(\.\d{1,3}){3}$"
_SSN_FORM = r"^\d{3}-\d\d-\d{4}$"
_ISO_FORM = r"^\d{4}-\d\d-\d\d$"
_PLAIN_PHONE_FORM = r"^\d{3}([.-])\d{3}\1\d{4}$"
_DMY_FORM = r"^\d\d[./]\d\d[./]\d{4}$"


def _digits(text: Column) -> Column:
    return F.regexp_replace(text, r"\D", "")


def _hash(key: str, kind: str, turn: Column, value: Column) -> Column:
    """60 bits of SHA-256 over key, kind, round and a half."""
    digest = F.sha2(F.concat_ws(":", F.lit(key), F.lit(kind), turn.cast("string"), value.cast("string")), 256)
    return F.conv(F.substring(digest, 1, 15), 16, 10).cast("bigint")


def _permuted(x: Column, y: Column, a: Column, b: Column, key: str, kind: str, undo: bool) -> Column:
    """struct<x, y>: the pair after an even number of Feistel rounds, or before them."""
    state = F.struct(*(v.cast("bigint").alias(n) for n, v in (("x", x), ("y", y), ("a", a), ("b", b))))

    def forward(s: Column, turn: Column) -> Column:
        mixed = F.pmod(s["x"] + F.pmod(_hash(key, kind, turn, s["y"]), s["a"]), s["a"])
        return F.struct(s["y"].alias("x"), mixed.alias("y"), s["b"].alias("a"), s["a"].alias("b"))

    def backward(s: Column, turn: Column) -> Column:
        plain = F.pmod(s["y"] - F.pmod(_hash(key, kind, turn, s["x"]), s["b"]), s["b"])
        return F.struct(plain.alias("x"), s["x"].alias("y"), s["b"].alias("a"), s["a"].alias("b"))

    turns = F.array(*[F.lit(t) for t in (range(ROUNDS, 0, -1) if undo else range(1, ROUNDS + 1))])
    return F.aggregate(turns, state, backward if undo else forward)


def _permuted_digits(digits: Column, key: str, kind: str, undo: bool) -> Column:
    """A string of digits as another of the same length."""
    n = F.length(digits)
    half = F.floor(n / 2).cast("int")
    left, right = F.left(digits, half), F.right(digits, n - half)
    moved = _permuted(left.cast("bigint"), right.cast("bigint"), F.pow(F.lit(10), half), F.pow(F.lit(10), n - half), key, kind, undo)
    return F.transform(
        F.array(moved), lambda m: F.concat(F.lpad(m["x"].cast("string"), half, "0"), F.lpad(m["y"].cast("string"), n - half, "0"))
    )[0]


def _refilled(form: Column, digits: Column, skip: Column) -> Column:
    """``form`` with its digits after the first ``skip`` replaced, in order."""
    signs = F.split(form, "")

    def step(done: Column, sign: Column) -> Column:
        digit = sign.between("0", "9")
        new = F.when(digit & (done["seen"] >= skip), F.substring(digits, done["seen"] - skip + 1, F.lit(1))).otherwise(sign)
        return F.struct((done["seen"] + digit.cast("int")).alias("seen"), F.concat(done["out"], new).alias("out"))

    return F.aggregate(signs, F.struct(F.lit(0).alias("seen"), F.lit("").alias("out")), step, lambda done: done["out"])


def _luhn_sum(digits: Column) -> Column:
    """Luhn sum of digits in which the last one counts once."""
    values = F.transform(F.reverse(F.split(digits, "")), lambda d, i: F.struct(d.cast("int").alias("d"), i.alias("i")))

    def step(total: Column, v: Column) -> Column:
        twice = v["d"] * 2
        return total + F.when(v["i"] % 2 == 0, v["d"]).otherwise(F.when(twice > 9, twice - 9).otherwise(twice))

    return F.aggregate(values, F.lit(0), step)


def _date_of(text: Column) -> Column:
    """The day of a date as written, null if there is none such. 12/31/1999 is read as month first."""
    first, second, year = F.substring(text, 1, 2), F.substring(text, 4, 2), F.substring(text, 7, 4)
    month_first = (second.try_cast("int") > 12) & text.contains("/")
    iso = (
        F.when(text.rlike(_ISO_FORM), text)
        .when(month_first, F.concat_ws("-", year, first, second))
        .otherwise(F.concat_ws("-", year, second, first))
    )
    return F.try_to_timestamp(iso, F.lit("yyyy-MM-dd")).cast("date")


def _kind(match: Column) -> Column:
    """Kind of a match, or null where it fails validation."""
    octets = F.split(match, r"\.")
    digits = _digits(match)
    n = F.length(digits)
    proper = F.forall(octets, lambda o: (F.length(o) == F.length(o.cast("int").cast("string"))) & (o.cast("int") <= 255))
    area, group, serial = F.substring(match, 1, 3), F.substring(match, 5, 2), F.substring(match, 8, 4)
    ssn = ~area.isin("000", "666") & (area < "900") & (group != "00") & (serial != "0000")
    day = match.rlike(_ISO_FORM) | match.rlike(_DMY_FORM)
    return (
        F.when(match.contains("@"), F.lit("email"))
        .when(match.rlike(_IP_FORM), F.when(proper, F.lit("ip")))
        .when(match.rlike(_SSN_FORM), F.when(ssn, F.lit("ssn")))
        .when(day, F.when(_date_of(match).isNotNull(), F.lit("date")))
        .when(match.rlike(_PLAIN_PHONE_FORM), F.lit("phone"))
        .when(match.startswith("+") | match.startswith("("), F.when(n.between(8, 15), F.lit("phone")))
        .when(n.between(13, 19), F.when(_luhn_sum(digits) % 10 == 0, F.lit("card")))
    )


def _new_card(match: Column, key: str, undo: bool) -> Column:
    digits = _digits(match)
    body = _permuted_digits(F.left(digits, F.length(digits) - 1), key, "card", undo)
    return F.transform(
        F.array(body), lambda b: _refilled(match, F.concat(b, F.pmod(-_luhn_sum(F.concat(b, F.lit("0"))), F.lit(10)).cast("string")), F.lit(0))
    )[0]


def _new_phone(match: Column, key: str, undo: bool) -> Column:
    """Keeps a country code that a separator ends; of other international numbers the first digit; of national ones none."""
    code = F.when(~match.startswith("+"), F.lit(0)).otherwise(
        F.greatest(F.lit(1), F.length(F.regexp_extract(match, r"^\+(\d{1,3})[ .(-]", 1)))
    )
    digits = _digits(match)
    return _refilled(match, _permuted_digits(F.right(digits, F.length(digits) - code), key, "phone", undo), code)


def _new_ip(match: Column, key: str, undo: bool) -> Column:
    o = F.transform(F.split(match, r"\."), lambda x: x.cast("bigint"))
    moved = _permuted(o[0] * 256 + o[1], o[2] * 256 + o[3], F.lit(65536), F.lit(65536), key, "ip", undo)
    return F.transform(
        F.array(moved),
        lambda m: F.concat_ws(".", *(F.floor(v).cast("string") for v in (m["x"] / 256, m["x"] % 256, m["y"] / 256, m["y"] % 256))),
    )[0]


def _new_ssn(match: Column, key: str, undo: bool) -> Column:
    area, group, serial = (F.substring(match, at, n).cast("bigint") for at, n in ((1, 3), (5, 2), (8, 4)))
    area = F.when(area > 666, area - 2).otherwise(area - 1)
    moved = _permuted(area * 99 + group - 1, serial - 1, F.lit(_SSN_AREAS * 99), F.lit(9999), key, "ssn", undo)

    def written(m: Column) -> Column:
        place = F.floor(m["x"] / 99)
        area = F.when(place >= 665, place + 2).otherwise(place + 1)
        parts = ((area, 3), (m["x"] % 99 + 1, 2), (m["y"] + 1, 4))
        return F.concat_ws("-", *(F.lpad(v.cast("bigint").cast("string"), n, "0") for v, n in parts))

    return F.transform(F.array(moved), written)[0]


def _new_date(match: Column, key: str, undo: bool) -> Column:
    a, b = _DAYS
    day = F.datediff(_date_of(match), F.lit(_FIRST_DAY).cast("date"))
    moved = _permuted(F.floor(day / b), day % b, F.lit(a), F.lit(b), key, "date", undo)
    month_first = (F.substring(match, 4, 2).try_cast("int") > 12) & match.contains("/")

    def written(m: Column) -> Column:
        new = F.date_add(F.lit(_FIRST_DAY).cast("date"), (m["x"] * b + m["y"]).cast("int"))
        iso = F.date_format(new, "yyyy-MM-dd")
        parts = F.split(iso, "-")
        sign = F.substring(match, 3, 1)
        return (
            F.when(match.rlike(_ISO_FORM), iso)
            .when(month_first, F.concat_ws("/", parts[1], parts[2], parts[0]))
            .otherwise(F.concat(parts[2], sign, parts[1], sign, parts[0]))
        )

    return F.transform(F.array(moved), written)[0]


def _new_email(match: Column, key: str, undo: bool) -> Column:
    """Shifts the signs of one half by a keyed hash of the other, class by class."""
    kept = F.substring_index(match, ".", -1)
    signs = F.split(F.left(match, F.length(match) - F.length(kept)), "")
    half = F.floor(F.size(signs) / 2).cast("int")
    state = F.struct(F.slice(signs, 1, half).alias("x"), F.slice(signs, half + 1, F.size(signs)).alias("y"))

    def shifted(half_signs: Column, other: Column, turn: Column) -> Column:
        by = F.array_join(other, "")

        def one(sign: Column, at: Column) -> Column:
            move = _hash(key, "email", turn * 4096 + at, by)
            new = F
            for alphabet in ALPHABETS:
                step = F.pmod(move, F.lit(len(alphabet)))
                place = F.pmod(F.position(sign, F.lit(alphabet)) - 1 + (-step if undo else step), F.lit(len(alphabet)))
                new = new.when(F.lit(alphabet).contains(sign), F.substring(F.lit(alphabet), (place + 1).cast("int"), F.lit(1)))
            return new.otherwise(sign)

        return F.transform(half_signs, one)

    def forward(s: Column, turn: Column) -> Column:
        return F.struct(s["y"].alias("x"), shifted(s["x"], s["y"], turn).alias("y"))

    def backward(s: Column, turn: Column) -> Column:
        return F.struct(shifted(s["y"], s["x"], turn).alias("x"), s["x"].alias("y"))

    turns = F.array(*[F.lit(t) for t in (range(ROUNDS, 0, -1) if undo else range(1, ROUNDS + 1))])
    return F.aggregate(
        turns, state, backward if undo else forward, lambda s: F.concat(F.array_join(s["x"], ""), F.array_join(s["y"], ""), kept)
    )


def _replaced(kind: Column, match: Column, key: str, undo: bool) -> Column:
    forms = {"email": _new_email, "ip": _new_ip, "card": _new_card, "phone": _new_phone, "ssn": _new_ssn, "date": _new_date}
    new = F
    for name, form in forms.items():
        new = new.when(kind == name, form(match, key, undo))
    return new.otherwise(match)


def session_key(spark: SparkSession) -> str:
    """The key of the session's setting ``KEY_SETTING``; where that is unset, a random one that the session then keeps."""
    if not spark.conf.get(KEY_SETTING, None):
        spark.conf.set(KEY_SETTING, secrets.token_hex(32))
    return spark.conf.get(KEY_SETTING)


def with_pseudonyms(docs: DataFrame, key: str, text_col: str = "text", found: str | None = None, undo: bool = False) -> DataFrame:
    """``docs`` with the text pseudonymised; ``found`` names a column for array<struct<start, end, match, kind>> of the old text."""
    text, pairs, tail = F.col(text_col), "__pii_pairs", "__pii_tail"
    # Whatever matches has a digit or an @, so texts without one need no search.
    wanted = F.coalesce(text.rlike("[0-9@]"), F.lit(False))
    gaps, rest = gaps_and_matches(text, PATTERN)
    kinds = F.transform(gaps, lambda p: F.struct(p["gap"].alias("gap"), p["match"].alias("match"), _kind(p["match"]).alias("kind")))
    marked = docs.withColumns({pairs: F.when(wanted, kinds), tail: F.when(wanted, rest)})
    parts = F.transform(pairs, lambda p: F.concat(p["gap"], F.when(p["kind"].isNull(), p["match"]).otherwise(_replaced(p["kind"], p["match"], key, undo))))
    new = F.when(F.coalesce(F.size(pairs), F.lit(0)) > 0, F.concat(F.array_join(parts, ""), F.coalesce(F.col(tail), F.lit("")))).otherwise(text)
    empty = "array<struct<start:bigint,end:bigint,match:string,kind:string>>"
    every = spans_of_pairs(F.coalesce(F.col(pairs), F.array().cast("array<struct<gap:string,match:string,kind:string>>")), empty, "kind")
    spans = F.filter(every, lambda s: s["kind"].isNotNull())
    out = docs.columns if found is None else [*(c for c in docs.columns if c != found), found]
    return marked.select(*(new.alias(c) if c == text_col else spans.alias(c) if c == found else F.col(c) for c in out))


def counts_and_spans(found: Column) -> list[Column]:
    """Columns n_<kind> for every kind, and the spans as kind:start:end."""
    counts = [F.size(F.filter(found, lambda s: s["kind"] == kind)).cast("bigint").alias(f"n_{kind}") for kind in KINDS]
    ranked = F.transform(found, lambda s: F.struct(s["start"].alias("start"), F.lit(0).alias("rank"), s["end"].alias("end"), s["kind"].alias("kind")))
    return [*counts, joined_spans(ranked).alias("spans")]
