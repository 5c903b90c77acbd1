"""Format-preserving Feistel pseudonyms for personal data, with DataFrame functions only.

One pattern finds candidates; each is validated (calendar dates, Luhn sums, address octets, social
security ranges) and permuted within its own format by a keyed Feistel network, so a pseudonym is
valid in the same format, has the same length, and equal values get equal pseudonyms in every
document. Numbers and dates are permuted as mixed-radix integers over exactly their valid values
(for cards the issuer's first digit stays and the check digit is recomputed); mail addresses and
credentials are permuted character by character within their alphabets. What is not valid stays.

Corner cases: null text stays null, empty text empty; texts of any length and any number of
findings are handled in one pass; repeated values and rows get the same pseudonyms; other columns
are kept. The work columns take names that the input does not use.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ROUNDS = 10

# The formats. Every pattern starts and ends on its own characters (no look-around
# needed to tell a match from its text), so the first alternative that matches names the kind.
_OCTET = r"(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
FORMATS = {
    "email": r"(?<![._%+\-])[A-Za-z0-9._%+\-]++@[A-Za-z0-9\-]++(?:\.[A-Za-z0-9\-]++)++",
    "access_key": r"A(?:KIA|SIA)[0-9A-Z]{16}(?![A-Za-z0-9])",
    "password": r"(?:[Pp]assword|PASSWORD|[Pp]asswd|PASSWD|[Pp]wd|PWD)[=:] ?[^\s\"']{6,}",
    "hex_token": r"[0-9a-f]{32,64}(?![A-Za-z0-9])",
    "date": r"(?<![0-9/.\-])(?:[0-9]{4}-[0-9]{2}-[0-9]{2}|[0-9]{2}/[0-9]{2}/[0-9]{4}|[0-9]{2}\.[0-9]{2}\.[0-9]{4})(?![0-9/\-]|\.[0-9])",
    "phone": r"(?<![0-9A-Za-z.\-])(?:\+[0-9]{1,3}[ .\-]?)?(?:\([0-9]{3}\) ?|[0-9]{3}[ .\-])[0-9]{3}[ .\-][0-9]{4}(?![0-9A-Za-z]|[.\-][0-9])",
    "ssn": r"(?<![0-9A-Za-z.\-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9A-Za-z]|[.\-][0-9])",
    "ip": r"(?<![0-9A-Za-z.])" + _OCTET + r"(?:\." + _OCTET + r"){3}(?![0-9A-Za-z]|\.[0-9])",
    "card": r"(?<![0-9A-Za-z.\-])[0-9](?:[ \-]?[0-9]){12,18}(?![0-9A-Za-z]|[.\-][0-9])",
}
KINDS = tuple(FORMATS)
_NUMBERS = ("date", "phone", "ssn", "ip", "card")
# Inside a word nothing is tried; numbers only where one can start.
PATTERN = (r"(?<![A-Za-z0-9])(?:" + "|".join(f"(?:{p})" for k, p in FORMATS.items() if k not in _NUMBERS)
           + r"|(?=[0-9+(])(?:" + "|".join(f"(?:{FORMATS[k]})" for k in _NUMBERS) + "))")
# A text without any of these has no candidate: keys and tokens may be of letters alone.
_HINT = "[0-9@=:]|A(?:KIA|SIA)[A-Z]{16}|[a-f]{32}"
_LOWER, _UPPER, _DIGIT, _HEX = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789", "0123456789abcdef"


def _long(x) -> Column:
    return x.cast("long") if isinstance(x, Column) else F.lit(x).cast("long")


def _prf(key: str, tag: str, round_: Column, *parts: Column) -> Column:
    """60 pseudo-random bits of the parts."""
    said = F.concat_ws("|", F.lit(key), F.lit(tag), round_.cast("string"), *[p.cast("string") for p in parts])
    return F.conv(F.substring(F.sha2(said, 256), 1, 15), 16, 10).cast("long")


def feistel(value: Column, a, b, key: str, tag: str, rounds: int = ROUNDS) -> Column:
    """A keyed permutation of 0 .. a*b - 1: the halves value div b and value mod b take turns, each
    shifted by a function of the other."""
    a, b = _long(a), _long(b)
    start = F.struct(
        ((value - F.pmod(value, b)) / b).cast("long").alias("l"), F.pmod(value, b).cast("long").alias("r"))

    def turn(s: Column, i: Column) -> Column:
        even = i % 2 == 0
        return F.struct(F.when(even, F.pmod(s["l"] + _prf(key, tag, i, s["r"]), a)).otherwise(s["l"]).cast("long").alias("l"),
                        F.when(even, s["r"]).otherwise(F.pmod(s["r"] + _prf(key, tag, i, s["l"]), b)).cast("long").alias("r"))
    return F.aggregate(F.sequence(F.lit(0), F.lit(rounds - 1)), start, turn, lambda s: s["l"] * b + s["r"])


def feistel_text(text: Column, alphabets: tuple[str, ...], key: str, tag: str, rounds: int = ROUNDS) -> Column:
    """A keyed permutation of texts of one length: each character stays in its alphabet; characters
    of no alphabet stay as they are. The halves of the text take turns."""
    half = F.floor(F.char_length(text) / 2).cast("int")

    def shifted(active: Column, other: Column, i: Column) -> Column:
        n = F.char_length(active)
        at = F.filter(F.sequence(F.lit(1), F.greatest(n, F.lit(1))), lambda j: j <= n)

        def char(j: Column) -> Column:
            c = F.substring(active, j, F.lit(1))
            out = None
            for alphabet in alphabets:
                p = F.instr(F.lit(alphabet), c)
                moved = F.substring(F.lit(alphabet), (F.pmod(p - 1 + _prf(key, tag, i, j, other), F.lit(len(alphabet))) + 1).cast("int"), F.lit(1))
                out = F.when(p > 0, moved) if out is None else out.when(p > 0, moved)
            return out.otherwise(c)
        return F.array_join(F.transform(at, char), "")

    def turn(s: Column, i: Column) -> Column:
        even = i % 2 == 0
        return F.struct(F.when(even, shifted(s["l"], s["r"], i)).otherwise(s["l"]).alias("l"),
                        F.when(even, s["r"]).otherwise(shifted(s["r"], s["l"], i)).alias("r"))
    start = F.struct(F.substring(text, F.lit(1), half).alias("l"), F.substring(text, half + 1, F.char_length(text)).alias("r"))
    return F.aggregate(F.sequence(F.lit(0), F.lit(rounds - 1)), start, turn, lambda s: F.concat(s["l"], s["r"]))


def _digits(m: Column) -> Column:
    return F.regexp_replace(m, "[^0-9]", "")


def _refill(m: Column, digits: Column) -> Column:
    """``m`` with its digits replaced, in order, by ``digits``."""
    def char(j: Column) -> Column:
        c = F.substring(m, j, F.lit(1))
        return F.when(c.rlike("[0-9]"), F.substring(digits, F.char_length(_digits(F.substring(m, F.lit(1), j))), F.lit(1))).otherwise(c)
    return F.array_join(F.transform(F.sequence(F.lit(1), F.char_length(m)), char), "")


def _pad(n: Column, width) -> Column:
    return F.lpad(n.cast("string"), width, "0")


def _int(text: Column, at: int, n: int) -> Column:
    return F.substring(text, at, n).cast("long")


def _let(value: Column, body) -> Column:
    """``body(value)`` with the value computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _luhn_rest(digits: Column) -> Column:
    """The Luhn sum of digits that the check digit follows, mod 10."""
    n = F.char_length(digits)
    def add(s: Column, j: Column) -> Column:
        d = F.substring(digits, n - j, F.lit(1)).cast("int")
        twice = d * 2 - F.when(d > 4, 9).otherwise(0)
        return s + F.when(j % 2 == 0, twice).otherwise(d)
    return F.aggregate(F.sequence(F.lit(0), n - 1), F.lit(0), add) % 10


def _card(m: Column, key: str) -> Column:
    def permuted(d: Column) -> Column:
        n = F.char_length(d)
        middle = F.substring(d, F.lit(2), n - 2)
        low = F.floor((n - 2) / 2).cast("int")
        power = lambda k: F.pow(F.lit(10.0), k).cast("long")  # noqa: E731  exact up to 10**9
        moved = _pad(feistel(middle.cast("long"), power(n - 2 - low), power(low), key, "card"), n - 2)
        body = F.concat(F.substring(d, 1, 1), moved)
        full = F.concat(body, ((10 - _luhn_rest(body)) % 10).cast("string"))
        valid = (_luhn_rest(F.substring(d, F.lit(1), n - 1)) + F.substring(d, n, F.lit(1)).cast("int")) % 10 == 0
        return F.when(valid, _refill(m, full))
    return _let(_digits(m), permuted)


def _date(m: Column, key: str) -> Column:
    # 400 Gregorian years have 146,097 = 189 * 773 days, whichever year they start with.
    def permuted(f: Column) -> Column:
        day = F.try_to_date(f["iso"]) if hasattr(F, "try_to_date") else F.to_date(f["iso"])
        year = F.substring(f["iso"], 1, 4).cast("int")
        valid = F.when((year >= 1800) & (year <= 2199), day)
        moved = F.date_add(F.lit("1800-01-01").cast("date"), feistel(F.datediff(valid, F.lit("1800-01-01").cast("date")).cast("long"), 189, 773, key, "date").cast("int"))
        return F.when(valid.isNotNull(), F.date_format(moved, "yyyy-MM-dd")).alias("d")
    d, iso, dots = _digits(m), m.rlike("^[0-9]{4}-"), m.contains(".")
    month_first = ~dots & (_int(m, 1, 2) <= 12)
    day_first = ~iso & ~dots & ~month_first
    text = (F.when(iso, m).when(month_first, F.concat_ws("-", F.substring(d, 5, 4), F.substring(d, 1, 2), F.substring(d, 3, 2)))
            .otherwise(F.concat_ws("-", F.substring(d, 5, 4), F.substring(d, 3, 2), F.substring(d, 1, 2))))
    def write(p: Column) -> Column:
        y, mo, da = F.substring(p, 1, 4), F.substring(p, 6, 2), F.substring(p, 9, 2)
        return F.when(p.isNull(), None).when(iso, p).otherwise(_refill(m, F.when(month_first, F.concat(mo, da, y)).otherwise(F.concat(da, mo, y))))
    return _let(F.when(day_first, _let(text, lambda t: _late_day(t, key))).otherwise(_let(F.struct(text.alias("iso")), permuted)), write)


# Months by length, and the leap years of 1800 to 2199.
_LONG_MONTHS, _MONTHS_OF_30 = (1, 3, 5, 7, 8, 10, 12), (1, 3, 4, 5, 6, 7, 8, 9, 10, 11, 12)
_LEAP_YEARS = tuple(y for y in range(1800, 2200) if y % 4 == 0 and (y % 100 != 0 or y % 400 == 0))


def _late_day(iso: Column, key: str) -> Column:
    """Dates written day first that only the day tells from month first: they move among themselves (days 13 to
    28 of all months; the 29th, 30th and 31st each among the months that have them), so that a pseudonym is read
    as it is written and no two dates get the same."""
    day = F.try_to_date(iso) if hasattr(F, "try_to_date") else F.to_date(iso)
    y, m, d = F.year(day), F.month(day), F.dayofmonth(day)

    def date(year: Column, month: Column, of: Column) -> Column:
        return F.concat_ws("-", year.cast("string"), F.lpad(month.cast("string"), 2, "0"), F.lpad(of.cast("string"), 2, "0"))

    def among(months: tuple[int, ...], tag: str) -> Column:
        have, n = F.array(*[F.lit(x) for x in months]), len(months)
        moved = feistel(((y - 1800) * n + F.array_position(have, m) - 1).cast("long"), 400, n, key, tag)
        return _let(moved, lambda v: date((v / n).cast("int") + 1800, F.element_at(have, (v % n + 1).cast("int")), d))

    middle = feistel((((y - 1800) * 12 + m - 1) * 16 + d - 13).cast("long"), 240, 320, key, "late day")
    leap = F.array(*[F.lit(x) for x in _LEAP_YEARS])
    leap_day = feistel((F.array_position(leap, y) - 1).cast("long"), len(_LEAP_YEARS), 1, key, "leap day")
    moved = (F.when(d <= 28, _let(middle, lambda v: date((v / 192).cast("int") + 1800, ((v / 16).cast("int") % 12) + 1, (v % 16 + 13).cast("int"))))
             .when((d == 29) & (m == 2), date(F.element_at(leap, (leap_day + 1).cast("int")), m, d))
             .when(d == 29, among(_MONTHS_OF_30, "29")).when(d == 30, among(_MONTHS_OF_30, "30")).otherwise(among(_LONG_MONTHS, "31")))
    return F.when((y >= 1800) & (y <= 2199), moved)


def _phone(m: Column, key: str) -> Column:
    # The last ten digits move, a country code stays.
    d = _digits(m)
    n = F.char_length(d)
    moved = feistel(F.substring(d, n - 9, F.lit(10)).cast("long"), 100_000, 100_000, key, "phone")
    return _refill(m, F.concat(F.substring(d, F.lit(1), n - 10), _pad(moved, 10)))


def _ssn(m: Column, key: str) -> Column:
    area, group, serial = _int(m, 1, 3), _int(m, 5, 2), _int(m, 8, 4)
    valid = (area > 0) & (area != 666) & (area < 900) & (group > 0) & (serial > 0)
    place = area - 1 - F.when(area > 666, 1).otherwise(0)
    def write(v: Column) -> Column:
        left = ((v - F.pmod(v, F.lit(9999))) / 9999).cast("long")
        ar = ((left - F.pmod(left, F.lit(99))) / 99).cast("long") + 1
        ar = ar + F.when(ar >= 666, 1).otherwise(0)
        return F.concat_ws("-", _pad(ar, 3), _pad(F.pmod(left, F.lit(99)) + 1, 2), _pad(F.pmod(v, F.lit(9999)) + 1, 4))
    return F.when(valid, _let(feistel((place * 99 + group - 1) * 9999 + serial - 1, 898 * 99, 9999, key, "ssn"), write))


def _ip(m: Column, key: str) -> Column:
    # Each octet keeps its number of digits: 0-9, 10-99 or 100-255.
    def size(o: Column) -> Column:
        return F.when(o < 10, 10).when(o < 100, 90).otherwise(156).cast("long")
    def base(o: Column) -> Column:
        return F.when(o < 10, 0).when(o < 100, 10).otherwise(100).cast("long")
    def permuted(o: Column) -> Column:
        own = [o[i] for i in range(4)]
        value = F.lit(0).cast("long")
        for x in own:
            value = value * size(x) + x - base(x)
        def write(v: Column) -> Column:
            rest, out = v, []
            for x in reversed(own):
                digit = F.pmod(rest, size(x))
                out.append((digit + base(x)).cast("string"))
                rest = ((rest - digit) / size(x)).cast("long")
            return F.concat_ws(".", *reversed(out))
        return _let(feistel(value, size(own[0]) * size(own[1]), size(own[2]) * size(own[3]), key, "ip"), write)
    return _let(F.transform(F.split(m, r"\."), lambda x: x.cast("long")), permuted)


def _email(m: Column, key: str) -> Column:
    # All but the top-level domain moves, letters and digits within their own kind.
    end = F.char_length(m) - F.char_length(F.substring_index(m, ".", -1))
    return F.concat(feistel_text(F.substring(F.lower(m), F.lit(1), end), (_LOWER, _DIGIT), key, "email"), F.substring_index(F.lower(m), ".", -1))


def _after(m: Column, head: Column, alphabets: tuple[str, ...], key: str, tag: str) -> Column:
    return F.concat(F.substring(m, F.lit(1), head), feistel_text(F.substring(m, head + 1, F.char_length(m)), alphabets, key, tag))


def kind_of(m: Column) -> Column:
    """The format that a candidate has."""
    out = None
    for kind, pattern in FORMATS.items():
        hit = m.rlike(f"^(?:{pattern})$")
        out = F.when(hit, kind) if out is None else out.when(hit, kind)
    return out


def pseudonym(m: Column, kind: Column, key: str) -> Column:
    """The pseudonym of a candidate; null where it is not valid."""
    return (F.when(kind == "email", _email(m, key))
            .when(kind == "access_key", _after(m, F.lit(4), (_UPPER + _DIGIT,), key, "access_key"))
            .when(kind == "password", _after(m, F.char_length(F.regexp_extract(m, r"^[A-Za-z]+[=:] ?", 0)), (_LOWER, _UPPER, _DIGIT), key, "password"))
            .when(kind == "hex_token", feistel_text(m, (_HEX,), key, "hex_token"))
            .when(kind == "date", _date(m, key)).when(kind == "phone", _phone(m, key)).when(kind == "ssn", _ssn(m, key))
            .when(kind == "ip", _ip(m, key)).when(kind == "card", _card(m, key)))


FOUND = "array<struct<kind:string,pseudonym:string>>"


def pseudonymise(df: DataFrame, *, key: str, text_col: str = "text", found_col: str | None = None) -> DataFrame:
    """``df`` with pseudonyms in ``text_col``; all other columns and rows as they are.

    ``found_col`` names an extra column: array of kind and pseudonym, in text order (a null
    pseudonym: a candidate that is not valid and stays).
    """
    taken = {c.lower() for c in df.columns}
    def fresh(name: str) -> str:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        return name
    hits, gaps, moved = fresh("pii_hits"), fresh("pii_gaps"), fresh("pii_moved")
    text = F.col(text_col)
    hinted = text.rlike(_HINT)
    step = df.withColumns({hits: F.when(hinted, F.regexp_extract_all(text, F.lit(PATTERN), F.lit(0))).otherwise(F.array().cast("array<string>"))})
    some = F.size(F.col(hits)) > 0

    def move(m: Column) -> Column:
        return _let(kind_of(m), lambda k: F.struct(k.alias("kind"), pseudonym(m, k, key).alias("pseudonym"), m.alias("found")))
    step = step.withColumns({moved: F.when(some, F.transform(F.col(hits), move)),
                             gaps: F.when(some, F.split(text, PATTERN, -1))})
    ends = F.concat(F.transform(F.col(moved), lambda x: F.coalesce(x["pseudonym"], x["found"])), F.array(F.lit("")))
    out = {text_col: F.when(some, F.array_join(F.zip_with(F.col(gaps), ends, lambda g, e: F.concat(g, e)), "")).otherwise(text)}
    keep = [c for c in df.columns]
    if found_col:
        out[found_col] = F.coalesce(F.transform(F.col(moved), lambda x: F.struct(x["kind"], x["pseudonym"])), F.array().cast(FOUND))
        keep += [found_col] if found_col not in keep else []
    return step.withColumns(out).select(*keep)
