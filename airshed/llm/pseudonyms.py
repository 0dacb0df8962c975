"""Format-preserving pseudonyms for personal data, in column expressions only.

One pattern finds candidates; what has a rule must pass it (Luhn for cards, mod 97 for
IBANs, octets for addresses, the calendar for dates, number ranges for SSNs), else it
stays. A value is then permuted within its format by a keyed Feistel network, so equal
values get equal pseudonyms in every document, different values different ones, and who
has no key cannot go back:

* symbols (cards, phones, SSNs, IBANs, e-mail names, keys, passwords, tokens): the value's
  variable symbols are split in halves; each round moves every symbol of one half within
  its own alphabet (digits, small or capital letters, hex digits) by bytes of a keyed hash of
  the other half. Check digits are computed anew; punctuation, prefixes, country codes and
  e-mail domains stay.
* addresses: the same over two 16-bit halves.
* dates: over the days of a 400-year calendar cycle (146,097 = 189 x 773, which gives the
  halves), so that a date stays a date; a date's pseudonym is the same in every notation.

Forms found (S: a space, no-break space, dot or hyphen):

* IBANs in one word, or of the registry's countries and lengths with a space or hyphen anywhere.
* cards in one word, grouped 4-4-4-1..7, 4-4-4-4-3, 4-6-4 or 4-6-5 by S; of a grouped card that
  fails Luhn's rule, the part without the last group may pass it.
* phones +1..3 digits and an area with two groups, digits in pairs (+33 1 23 45 67 89,
  +34 612 34 56 78, +34 91 234 56 78) or after a trunk zero in brackets; national ones with a
  leading 0 in pairs, as area and number (030/1234567, (030) 1234567) or in three groups;
  612 34 56 78; ten digits as 3-3-4 by S, the first three also in brackets.
* dates 2024-12-31, 31.12.2024 and 12/31/2024; the day is first where the month cannot be.
* secrets after the names of NAMES (any case), quoted or not, with = : := or => and spaces.

The text is split at the matches and joined again. A value is matched to its end, however
long it is: runs are possessive and begin where a run begins, so each is read once and long
texts take time in proportion; other quantifiers are bounded by the format. There is no shuffle.

A null text stays null, an empty one empty, and neither has replacements; repeated rows
are treated alike; ids play no part; an empty table gives an empty result; other columns
pass through, but for a clashing n_replaced, which is replaced.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .hostrules import let
from .tables import read_table

KEY = "an example key: give your own"
ROUNDS = 8

# fixed values: formats
EMAIL = r"(?<![\w.%+-])[A-Za-z0-9._%+-]++@(?:[A-Za-z0-9-]++\.){1,127}[A-Za-z]{2,}+"  # a domain has 127 labels at most
S, GAP = r"[ \u00a0\u202f.-]", r"[ \u00a0\u202f-]"
IBAN_LENGTHS = {
    15: "NO", 16: "BE", 18: "DK FI FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH HR LI LV", 22: "BG BH CR DE GB GE IE ME RS VA",
    23: "AE GI IL IQ OM SO TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG", 25: "LY PT ST", 26: "IS TR", 27: "BI DJ FR GR IT MC MR SM",
    28: "AL AZ BY CY DO GT HU LB NI PL SV", 29: "BR EG PS QA UA", 30: "JO KW MU YE", 31: "MT SC", 32: "LC", 33: "RU",
}
_SPACED = "|".join(rf"(?:{c.replace(' ', '|')})(?:{GAP}?\d){{2}}(?:{GAP}?[A-Z0-9]){{{n - 4}}}" for n, c in IBAN_LENGTHS.items())
IBAN = rf"(?<!\w)(?:[A-Z]{{2}}\d{{2}}[A-Z0-9]{{11,30}}|(?=[A-Z]{{2}}{GAP}?\d)(?:{_SPACED}))(?!\w)"
DATE = r"(?<!\w)(?:\d{4}-\d{2}-\d{2}|\d{2}\.\d{2}\.\d{4}|\d{2}/\d{2}/\d{4})(?!\w)"
ADDRESS = r"(?<![\w.])(?:\d{1,3}\.){3}\d{1,3}(?!\w|\.\d)"
_ABROAD = rf"\+\d{{1,3}}{S}?(?:\(0\){S}?)?"
PHONE = "|".join([
    r"(?<![\w+])\+\d{1,3}[ .-]?(?:\(\d{2,4}\)|\d{2,4})[ .-]?\d{3,4}[ .-]?\d{3,4}(?!\w)",
    r"(?<!\w)(?:\(\d{3}\) ?|\d{3}-)\d{3}-\d{4}(?!\w)",
    rf"(?<![\w+]){_ABROAD}(?:\d(?:{S}?\d{{2}}){{4}}|\d{{2,5}}(?:{S}\d{{2}}){{2,5}}|\d{{2,3}}{S}\d{{3}}(?:{S}\d{{2}}){{2}}|\(?\d{{1,5}}\)?(?: ?/ ?|{S}?)\d{{3,4}}{S}?\d{{2,5}})(?!\w)",
    rf"(?<!\w)(?!\d{{4}}{S}\d{{4}}{S}\d{{4}}{S}\d)(?:0\d(?:{S}\d{{2}}){{4}}|(?:\(0\d{{1,4}}\) ?|0\d{{1,4}}(?: ?/ ?|{GAP}))(?:\d{{5,9}}|\d{{3,4}}{GAP}\d{{3,5}}|\d{{2}}(?:{GAP}\d{{2}}){{2,4}}))(?!\w)",
    rf"(?<!\w)(?:[6-9]\d{{2}}(?:{S}\d{{2}}){{3}}|[89]\d{S}\d{{3}}(?:{S}\d{{2}}){{2}}|(?:\(\d{{3}}\){S}?|\d{{3}}{S})\d{{3}}{S}\d{{4}})(?!\w)",
])
SSN = r"(?<!\w)\d{3}-\d{2}-\d{4}(?!\w)"
CARD = rf"(?<!\w)(?:\d{{13,19}}|\d{{4}}{S}\d{{4}}{S}\d{{4}}{S}(?:\d{{4}}{S}\d{{3}}|\d{{1,7}})|\d{{4}}{S}\d{{6}}{S}\d{{4,5}})(?!\w)"
ACCESS_KEY = r"(?<!\w)AKIA[0-9A-Z]{16}(?!\w)"
PASSWORD = r"(?<=password=)[^\s\"']++"
TOKEN = r"(?<=token = \")[^\s\"]++(?=\")"
NAMES = r"(?:password|passwort|passwd|passphrase|pwd|secret|token|(?:api|access|private|secret)[ _-]?key)"
_HEAD = rf"(?<![A-Za-z0-9])(?i:{NAMES})[\"']?[ \t]*+(?::=|=>|[=:])[ \t]*+"
_NAMED = rf"(?!password=[^\s\"'])(?!token = \"[^\s\"]++\"){_HEAD}"  # but for the spellings above
SECRET = rf"{_NAMED}(?:\"[^\"\r\n]++\"|'[^'\r\n]++'|[^\s\"']++)"
PATTERN = "|".join([EMAIL, IBAN, DATE, ADDRESS, PHONE, SSN, CARD, ACCESS_KEY, PASSWORD, TOKEN, SECRET])
DIGITS, SMALL, CAPITAL, HEX = "0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789abcdef"
CYCLE, DAYS_A, DAYS_B = 146_097, 189, 773


def _hash(key: str, *parts: Column) -> Column:
    return F.sha2(F.concat_ws("|", F.lit(key), *(p.cast("string") for p in parts)), 512)


def _number(hex_: Column, at, digits: int) -> Column:
    return F.conv(F.substring(hex_, at, digits) if isinstance(at, int) else F.substr(hex_, at, F.lit(digits)), 16, 10).cast("long")


def _chars(s: Column) -> Column:
    return F.split(s, "")


def _moved(half: Column, stream: Column, alphabets: tuple[str, ...]) -> Column:
    """Each symbol moved within its alphabet by a byte of the stream."""

    def move(c, i):
        step = _number(stream, 2 * F.pmod(i, F.lit(64)) + 1, 2).cast("int")
        out = c
        for a in reversed(alphabets):
            place = F.instr(F.lit(a), c)
            out = F.when(place > 0, F.substr(F.lit(a), F.pmod(place - 1 + step, F.lit(len(a))) + 1, F.lit(1))).otherwise(out)
        return out

    return F.when(half == "", half).otherwise(F.array_join(F.transform(_chars(half), move), ""))


def permute_symbols(value: Column, key: str, kind: str, alphabets: tuple[str, ...]) -> Column:
    """Feistel over a string: halves are swapped each round, symbols keep their alphabet."""
    cut = (F.length(value) / 2).cast("int")
    start = F.struct(F.substr(value, F.lit(1), cut).alias("l"), F.substr(value, cut + 1, F.length(value)).alias("r"))

    def step(a, k):
        return F.struct(a["r"].alias("l"), _moved(a["l"], _hash(key, F.lit(kind), k, a["r"]), alphabets).alias("r"))

    return F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)), start, step, lambda a: F.concat(a["l"], a["r"]))


def permute_number(value: Column, key: str, kind: str, a: int, b: int) -> Column:
    """Feistel over the numbers below a * b."""
    start = F.struct(F.floor(value / b).alias("x"), F.pmod(value, F.lit(b).cast("long")).alias("y"))

    def step(s, k):
        f = _number(_hash(key, F.lit(kind), k, F.when(k % 2 == 0, s["x"]).otherwise(s["y"])), 1, 12)
        x = F.when(k % 2 == 1, F.pmod(s["x"] + f, F.lit(a).cast("long"))).otherwise(s["x"])
        y = F.when(k % 2 == 0, F.pmod(s["y"] + f, F.lit(b).cast("long"))).otherwise(s["y"])
        return F.struct(x.alias("x"), y.alias("y"))

    return F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)), start, step, lambda s: s["x"] * b + s["y"])


def _digits(m: Column) -> Column:
    return F.regexp_replace(m, r"\D", "")


def _refilled(shape: Column, digits: Column, skip: Column, alphabet: str = DIGITS) -> Column:
    """`shape` with its digits (symbols of `alphabet`), but for the first `skip`, replaced in order."""

    def put(a, c):
        digit = F.instr(F.lit(alphabet), c) > 0
        k = a["k"] + F.when(digit, 1).otherwise(0)
        new = F.when(digit & (k > skip), F.substr(digits, k - skip, F.lit(1))).otherwise(c)
        return F.struct(F.concat(a["s"], new).alias("s"), k.alias("k"))

    return F.aggregate(_chars(shape), F.struct(F.lit("").alias("s"), F.lit(0).alias("k")), put, lambda a: a["s"])


def luhn_sum(digits: Column, first_doubled: int) -> Column:
    """Luhn's sum from the right; the rightmost digit is doubled if `first_doubled`."""

    def add(total, c, i):
        d = c.cast("int")
        twice = F.when(d > 4, 2 * d - 9).otherwise(2 * d)
        return total + F.when(F.pmod(i + first_doubled, F.lit(2)) == 1, twice).otherwise(d)

    with_place = F.transform(F.reverse(_chars(digits)), lambda c, i: F.struct(c.alias("c"), i.alias("i")))
    return F.aggregate(with_place, F.lit(0), lambda t, x: add(t, x["c"], x["i"]))


def _card(m: Column, key: str) -> Column:
    def new(d):
        body = permute_symbols(F.substr(d, F.lit(1), F.length(d) - 1), key, "card", (DIGITS,))
        return let(body, lambda b: F.concat(b, F.pmod(10 - luhn_sum(b, 1) % 10, F.lit(10)).cast("string")))

    def valid(d):
        return (F.length(d) >= 13) & (luhn_sum(d, 0) % 10 == 0)

    # what is no card as a whole may be one without its last group (a check value that follows)
    def part(d):
        last = F.length(F.regexp_extract(m, rf"{S}(\d+)$", 1))
        return F.when(valid(d), d).when(last > 0, let(F.substr(d, F.lit(1), F.length(d) - last), lambda x: F.when(valid(x), x)))

    return let(_digits(m), lambda d: let(part(d), lambda x: F.when(x.isNotNull(), let(F.concat(new(x), F.substr(d, F.length(x) + 1, F.length(d))), lambda n: _refilled(m, n, F.lit(0)))).otherwise(m)))


def _mod97(s: Column) -> Column:
    def add(t, c):
        v = F.instr(F.lit(DIGITS + CAPITAL), c) - 1
        return (t * F.when(v > 9, 100).otherwise(10) + v) % 97

    return F.aggregate(_chars(s), F.lit(0), add)


def _iban(m: Column, key: str) -> Column:
    def new(s):
        country, body = F.substr(s, F.lit(1), F.lit(2)), F.substr(s, F.lit(5), F.length(s))
        checked = let(permute_symbols(body, key, "iban", (DIGITS, CAPITAL)), lambda b: F.concat(country, F.lpad((98 - _mod97(F.concat(b, country, F.lit("00")))).cast("string"), 2, "0"), b))
        valid = _mod97(F.concat(body, F.substr(s, F.lit(1), F.lit(4)))) == 1
        return F.when(valid, let(checked, lambda n: _refilled(m, n, F.lit(0), DIGITS + CAPITAL))).otherwise(m)

    return let(F.regexp_replace(m, GAP, ""), new)


def _address(m: Column, key: str) -> Column:
    octets = F.transform(F.split(m, r"\."), lambda o: o.cast("long"))

    def new(o):
        return let(
            permute_number(F.aggregate(o, F.lit(0).cast("long"), lambda t, x: t * 256 + x), key, "address", 65536, 65536),
            lambda n: F.concat_ws(".", *(F.shiftright(n, s).bitwiseAND(F.lit(255)).cast("string") for s in (24, 16, 8, 0))),
        )

    return let(octets, lambda o: F.when(F.array_max(o) <= 255, new(o)).otherwise(m))


def _date_as(m: Column, key: str, form: str) -> Column:
    def new(d):
        moved = F.floor(d / CYCLE) * CYCLE + permute_number(F.pmod(d, F.lit(CYCLE).cast("long")), key, "date", DAYS_A, DAYS_B)
        # a cycle that leaves the four-digit years cannot hold the pseudonym: such dates stay
        return F.when(d.between(-4 * CYCLE, 20 * CYCLE - 1), F.date_format(F.date_from_unix_date(moved.cast("int")), form)).otherwise(m)

    return let(F.unix_date(F.try_to_timestamp(m, F.lit(form)).cast("date")).cast("long"), new)


def _date(m: Column, key: str) -> Column:
    month_first = F.try_to_timestamp(m, F.lit("MM/dd/yyyy")).isNotNull()
    slashes = F.when(month_first, _date_as(m, key, "MM/dd/yyyy")).otherwise(_date_as(m, key, "dd/MM/yyyy"))
    other = F.when(m.contains("."), _date_as(m, key, "dd.MM.yyyy")).otherwise(slashes)
    return F.when(m.rlike(r"^\d{4}-"), _date_as(m, key, "yyyy-MM-dd")).otherwise(other)


def _phone(m: Column, key: str) -> Column:
    """The country code, the digits before the last ten at most, stays, and so does a trunk zero."""

    def new(d):
        code = F.when(F.startswith(m, F.lit("+")), F.greatest(F.length(F.regexp_extract(m, r"^\+(\d{1,3})[ .(-]", 1)), F.length(d) - 10)).otherwise(0)
        trunk = F.length(F.regexp_extract(m, r"^\+(\d{1,3}[ \u00a0\u202f.-]?\(0)\)", 1)) > 0
        code = F.when(trunk, F.length(_digits(F.substring_index(m, ")", 1)))).when(m.rlike(r"^\(?0"), F.lit(1)).otherwise(code)
        return let(code, lambda k: let(permute_symbols(F.substr(d, k + 1, F.length(d)), key, "phone", (DIGITS,)), lambda n: _refilled(m, n, k)))

    return let(_digits(m), new)


def _ssn(m: Column, key: str) -> Column:
    valid = ~m.rlike(r"^(?:000|666|9\d\d)-|-00-|-0000$")
    return F.when(valid, let(permute_symbols(_digits(m), key, "ssn", (DIGITS,)), lambda n: _refilled(m, n, F.lit(0)))).otherwise(m)


def _value(m: Column, key: str) -> Column:
    """The pseudonym of one value; itself if it fails its rule."""

    def whole(pattern):
        return m.rlike(f"^(?:{pattern})$")

    mixed = (DIGITS, SMALL, CAPITAL)
    email = let(F.substring_index(m, "@", 1), lambda n: F.concat(permute_symbols(n, key, "email", mixed), F.substr(m, F.length(n) + 1, F.length(m))))
    rules = [
        (whole(EMAIL), email),
        (whole(DATE), _date(m, key)),
        (whole(ADDRESS), _address(m, key)),
        (whole(ACCESS_KEY), F.concat(F.lit("AKIA"), permute_symbols(F.substr(m, F.lit(5), F.lit(16)), key, "access key", (DIGITS + CAPITAL,)))),
        (whole(IBAN), _iban(m, key)),
        (whole(SSN), _ssn(m, key)),
        (whole(PHONE), _phone(m, key)),
        (whole(CARD), _card(m, key)),
        (m.rlike("^[0-9a-f]{8,}$"), permute_symbols(m, key, "hex", (HEX,))),
    ]
    return reduce(lambda rest, r: F.when(*r).otherwise(rest), reversed(rules), permute_symbols(m, key, "secret", mixed))


def pseudonym(m: Column, key: str) -> Column:
    """The pseudonym of one candidate, what names and quotes a secret kept."""

    def named(head):
        quote = F.regexp_extract(F.substr(m, F.length(head) + 1, F.lit(1)), "[\"']", 0)
        value = F.substr(m, F.length(head) + F.length(quote) + 1, F.length(m) - F.length(head) - 2 * F.length(quote))
        new = let(value, lambda v: let(_value(v, key), lambda n: F.when((head != "") & (n == v), permute_symbols(v, key, "secret", (DIGITS, SMALL, CAPITAL))).otherwise(n)))
        return F.concat(head, quote, new, quote)

    return let(F.regexp_extract(m, f"^{_NAMED}", 0), lambda head: F.when(head == "", _value(m, key)).otherwise(named(head)))


def pseudonymise(docs: DataFrame, key: str = KEY) -> DataFrame:
    """The input's columns, `text` with pseudonyms, and n_replaced."""
    kept = [c for c in docs.columns if c not in ("text", "n_replaced")]
    text = F.col("text").cast("string")
    found = F.regexp_extract_all(text, F.lit(PATTERN), F.lit(0))
    out = docs.select(*kept, text.alias("text"), found.alias("__found"))
    new = F.when(F.size("__found") > 0, F.transform("__found", lambda m: pseudonym(m, key)))
    out = out.select(*kept, "text", "__found", new.alias("__new"))
    between = F.split("text", PATTERN, -1)
    joined = F.array_join(F.flatten(F.zip_with(between, "__new", lambda b, n: F.array(b, F.coalesce(n, F.lit(""))))), "")
    changed = F.filter(F.zip_with("__found", "__new", lambda a, b: a != b), lambda x: x)
    n = F.coalesce(F.when(F.size("__found") > 0, F.size(changed)), F.lit(0)).cast("long")
    out = out.withColumns({"n_replaced": n, "__text": F.when(F.size("__found") > 0, joined).otherwise(F.col("text"))})
    order = [F.col("__text").alias("text") if c == "text" else F.col(c) for c in docs.columns if c != "n_replaced"]
    return out.select(*order, "n_replaced")


def op10_pii_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pseudonymise(read_table(spark, sf_dir, "documents").select("doc_id", "text"))
