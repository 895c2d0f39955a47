r"""Personal data: format-preserving Feistel pseudonyms, in SQL functions only.

Emails, phone (North American, or international with a plus sign) and
social-security numbers, IPv4 addresses, card numbers,
access keys and dates are found by one pattern, validated by kind (octets up
to 255, Luhn digit, issued social-security number, real calendar date) and permuted within their own format
by a keyed Feistel network.  A pseudonym has the separators, letter case,
length and validity of its value; equal values get equal pseudonyms in every
document, and different values of a format stay different.

A phone number has one pseudonym in all its writings, and a card number too:
only the digits are permuted, and separators are put back.  The key reaches the
plan as one SHA-2 digest a kind, never itself; whoever reads a plan can undo
pseudonyms with these digests, so keep plans and event logs as secret as the key.

A value is a list of numbers with their moduli: digits modulo 10, letters
modulo their alphabet, octets modulo the count of octets of their length (one
with leading zeros is not valid), a date's day within 73,080 days
(280 x 261, about two centuries).  A slash date is MM/dd/yyyy where that is a
date, else dd/MM/yyyy; the latter moves among the days after the 12th.  Each of eight rounds adds to one half of
the list a key stream derived by SHA-2 from the key, the round and the other
half; a list of one number takes its place in a keyed order instead.  A card's last digit is computed anew; country codes, the mail domain and
the prefix of an access key stay.

The text is cut at the matches and joined again, so a row is worked on by
itself in one scan.  A text is searched when it holds what some kind needs: a
digit, an ``@``, ``AKIA`` or 20 letters a-f in a row.  Defined
results: a null text stays null, an empty one empty; a match that fails its
validation stays as it is; repeated rows and ids are treated alike.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from encore.llm.names import quoted, unused
from encore.llm.quality_rules import _let

KEY = "replace-me"       # the caller's secret in production
ROUNDS = 8

DIGITS, LOWER, UPPER = "0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
ACCENTED = "ßàáâãäåæçèéêëìíîïðñòóôõöøùúûüýþÿ"
HEX = "0123456789abcdef"
PERMUTED = "[0-9a-zA-Zßà-öø-ÿ]"         # characters that have an alphabet

EMAIL = r"(?<![\p{L}\p{N}._%+-])[\p{L}\p{N}._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
ACCESS_KEY = r"(?<![A-Za-z0-9])AKIA[0-9A-Z]{16}(?![A-Za-z0-9])"
HEX_KEY = r"(?<![A-Za-z0-9])[0-9a-f]{20,128}(?![A-Za-z0-9])"
DATE = (r"(?<![\w-])\d{4}-\d{2}-\d{2}(?![\w-])|(?<![\w/])\d{2}/\d{2}/\d{4}(?![\w/])"
        r"|(?<![\w.])\d{2}\.\d{2}\.\d{4}(?!\w)")
SSN = r"(?<![\w-])\d{3}-\d{2}-\d{4}(?![\w-])"
PHONE = (r"(?<![\w+])\+?\d{1,3}[ .-]?\(\d{3}\)[ .-]?\d{3}[ .-]\d{4}(?!\d)"
         r"|(?<![\w.(+])\(?\d{3}\)?[ .-]\d{3}[ .-]\d{4}(?!\d)")
# international numbers: +1 and +7 with 10 digits, +33 and +34 with 9, others with 6 to 12;
# a sign, digits and 4 to 7 decimals are a coordinate
_CODE = r"(?>[17]|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58]|\d{3})"
_TRUNK = r"(?:[ .-]?\(0\))?"
_NEXT = r"(?:[ ./-]?\(?\d\)?)"
INTERNATIONAL = (rf"(?<![\w+])\+(?!\d+\.\d{{4,7}}(?!\d|[./-]\d))(?:[17]{_NEXT}{{9}}|3[34]{_TRUNK}{_NEXT}{{8}}"
                 rf"|(?![17]|3[34]){_CODE}{_TRUNK}{_NEXT}{{5,11}})[ ./-]?\d(?!\w)")
UNSEPARATED = r"(?<![\w.+-])1?[2-9]\d{2}[2-9]\d{6}(?![\w-]|\.\d)"
IPV4 = r"(?<![\w.])\d{1,3}(?:\.\d{1,3}){3}(?!\w)(?!\.\d)"
CARD = r"(?<!\w)\d(?:[ -]?\d){12,18}(?!\w)"
ANY = "|".join([EMAIL, ACCESS_KEY, HEX_KEY, DATE, SSN, PHONE, INTERNATIONAL, UNSEPARATED, IPV4, CARD])
MAY_HOLD = "[0-9@]|AKIA|[a-f]{20}"      # every match of ANY holds one of these

DATE_FORMATS = {r"^\d{4}-": "yyyy-MM-dd", r"^\d{2}/": "MM/dd/yyyy", r"^\d{2}\.": "dd.MM.yyyy"}
DAY_ZERO = "1900-01-01"
DAYS = (280, 261)
FIRST_YEAR, LAST_YEAR = 1500, 2499
LATE_DAYS = (216, 205)   # days after the 12th of a month, about two centuries


def _one_of(value: Column, modulus: Column, salt: Column) -> Column:
    """Keyed permutation of a single number: its place in an order by digest."""
    table = F.array_sort(F.transform(F.sequence(F.lit(0), modulus - 1), lambda x: F.struct(
        F.sha2(F.concat_ws("|", salt, modulus.cast("string"), x.cast("string")), 256).alias("h"), x.alias("x"))))
    return F.get(table, value)["x"].cast("int")


def feistel(values: Column, moduli: Column, salt: Column) -> Column:
    """Keyed permutation of a list of numbers, each below its modulus."""
    return _let(F.struct(values.alias("v"), moduli.alias("m")), lambda x: _feistel(x["v"], x["m"], salt))


def _feistel(values: Column, moduli: Column, salt: Column) -> Column:
    half = F.floor(F.size(values) / 2).cast("int")

    def step(acc: Column, r: Column) -> Column:
        mine = lambda i: (i < half) == (r % 2 == 0)
        other = F.array_join(F.transform(F.filter(acc, lambda v, i: ~mine(i)),
                                         lambda v: v.cast("string")), ",")
        digest = F.sha2(F.concat_ws("|", salt, r.cast("string"), F.size(acc).cast("string"), other), 256)

        def shift(h: Column) -> Column:
            stream = lambda i: F.conv(F.substring(h, (i % 16) * 4 + 1, F.lit(4)), 16, 10).cast("int")
            return F.transform(acc, lambda v, i: F.when(
                mine(i), (v + stream(i)) % F.get(moduli, i)).otherwise(v))
        return _let(digest, shift)

    return F.when(F.size(values) == 1, F.array(_one_of(F.get(values, F.lit(0)), F.get(moduli, F.lit(0)), salt))).otherwise(
        F.aggregate(F.sequence(F.lit(0), F.lit(ROUNDS - 1)), values, step))


def _alphabet(c: Column, hexadecimal: bool) -> Column:
    inside = lambda a: F.position(c, F.lit(a)) > 0
    if hexadecimal:
        return F.when(inside(HEX), F.lit(HEX)).otherwise(F.lit(""))
    case = F.when(inside(DIGITS), F.lit(DIGITS))
    for a in (LOWER, UPPER, ACCENTED):
        case = case.when(inside(a), F.lit(a))
    return case.otherwise(F.lit(""))


def _put_back(body: Column, pattern: str, new: Column) -> Column:
    """``body`` with the matches of a one-character pattern replaced in order."""
    return F.array_join(F.zip_with(F.split(body, pattern, -1), new, lambda gap, c: F.concat(
        gap, F.coalesce(c, F.lit("")))), "")


def characters(body: Column, salt: Column, hexadecimal: bool = False) -> Column:
    """Permutes letters and digits within their alphabets, in place; what stands
    between them has no part in it, so a value is linked in all its writings."""
    pattern = "[0-9a-f]" if hexadecimal else PERMUTED

    def permuted(cs: Column) -> Column:
        sets = F.transform(cs, lambda c: _alphabet(c, hexadecimal))
        return _let(sets, lambda ss: _let(
            feistel(F.zip_with(cs, ss, lambda c, s: F.greatest(F.position(c, s) - 1, F.lit(0))),
                    F.transform(ss, lambda s: F.greatest(F.char_length(s), F.lit(1))), salt),
            lambda vs: _put_back(body, pattern, F.transform(cs, lambda c, i: F.when(F.get(ss, i) == "", c).otherwise(
                F.substring(F.get(ss, i), F.get(vs, i) + 1, F.lit(1)))))))
    return F.when(body.rlike(pattern), _let(
        F.regexp_extract_all(body, F.lit(pattern), F.lit(0)), permuted)).otherwise(body)


def _after(m: Column, prefix: Column, permuted) -> Column:
    """``prefix``, and the rest of ``m`` permuted."""
    return _let(F.struct(m.alias("m"), prefix.alias("p")), lambda x: _let(
        F.substring(x["m"], F.char_length(x["p"]) + 1, F.char_length(x["m"])),
        lambda rest: F.concat(x["p"], permuted(rest))))


def _within(body: Column, low: list[int], sizes: list[int], widths: list[int], salt: Column) -> Column:
    """Permutes the digits of ``body``, read as numbers of these widths, each
    at least ``low`` and one of ``sizes`` many."""
    starts = [sum(widths[:k]) + 1 for k in range(len(widths))]
    values = _let(F.regexp_replace(body, "[^0-9]", ""), lambda digits: F.array(*[
        F.substring(digits, at, w).cast("int") - lo for at, w, lo in zip(starts, widths, low)]))
    return _let(feistel(values, F.array(*map(F.lit, sizes)), salt), lambda vs: _put_back(
        body, "[0-9]", F.filter(F.split(F.concat(*[
            F.lpad((vs[k] + low[k]).cast("string"), w, "0") for k, w in enumerate(widths)]), ""), lambda c: c != "")))


def _luhn_sum(payload: Column) -> Column:
    digits = F.reverse(F.filter(F.split(payload, ""), lambda c: c.between("0", "9")))
    worth = F.transform(digits, lambda c, i: F.when(
        i % 2 == 0, c.cast("int") * 2 - F.when(c.cast("int") > 4, 9).otherwise(0)).otherwise(c.cast("int")))
    return F.aggregate(worth, F.lit(0), lambda a, x: a + x)


def luhn_digit(payload: Column) -> Column:
    """The digit that completes ``payload`` (other characters are skipped)."""
    return ((F.lit(10) - _luhn_sum(payload) % 10) % 10).cast("string")


def _card(m: Column, salt: Column) -> Column:
    n = F.char_length(m)
    body, last = F.substring(m, F.lit(1), n - 1), F.substring(m, n, F.lit(1))
    return F.when(luhn_digit(body) == last, _let(_let(
        body, lambda b: characters(b, salt)), lambda b: F.concat(b, luhn_digit(b)))).otherwise(m)


def _ipv4(m: Column, salt: Column) -> Column:
    # an octet moves among those of its own length, so the text keeps its length
    octets = F.transform(F.split(m, r"\."), lambda o: F.struct(
        o.cast("int").alias("v"),
        F.when(F.char_length(o) == 1, 0).when(F.char_length(o) == 2, 10).otherwise(100).alias("low"),
        F.when(F.char_length(o) == 1, 10).when(F.char_length(o) == 2, 90).otherwise(156).alias("m")))
    valid = lambda os: F.forall(os, lambda o: (o["v"] >= o["low"]) & (o["v"] < o["low"] + o["m"]))
    return _let(octets, lambda os: F.when(valid(os), _let(
        feistel(F.transform(os, lambda o: o["v"] - o["low"]), F.transform(os, lambda o: o["m"]), salt),
        lambda vs: F.array_join(F.zip_with(os, vs, lambda o, v: (o["low"] + v).cast("string")), "."))).otherwise(m))


def _date(m: Column, salt: Column, fmt: str) -> Column:
    span = DAYS[0] * DAYS[1]
    zero = F.lit(DAY_ZERO).cast("date")

    def permuted(day: Column) -> Column:
        n = F.datediff(day, zero)
        window, rest = F.floor(n / span).cast("int"), F.pmod(n, F.lit(span))
        parts = F.array(F.floor(rest / DAYS[1]).cast("int"), (rest % DAYS[1]).cast("int"))
        return _let(feistel(parts, F.array(*map(F.lit, DAYS)), salt), lambda v: F.date_format(
            F.date_add(zero, window * span + v[0] * DAYS[1] + v[1]), fmt))

    day = F.try_to_date(m, fmt)
    return _let(day, lambda d: F.when(F.year(d).between(FIRST_YEAR, LAST_YEAR), permuted(d)).otherwise(m))


def _late_date(m: Column, salt: Column) -> Column:
    """A dd/MM/yyyy date that cannot be MM/dd/yyyy moves among its like, the
    days after the 12th, so it never takes the pseudonym of a MM/dd/yyyy date."""
    span = LATE_DAYS[0] * LATE_DAYS[1]
    zero = F.lit(DAY_ZERO).cast("date")
    # number of late days before a month, counted from the first of DAY_ZERO's
    before = lambda month: F.datediff(F.add_months(zero, month), zero) - 12 * month

    def late_day(n: Column) -> Column:
        near = F.floor(n / 18.436875).cast("int")      # mean late days of a month
        months = F.transform(F.sequence(near - 2, near + 2), lambda k: F.struct(k.alias("k"), before(k).alias("n")))
        return _let(F.array_max(F.filter(months, lambda x: x["n"] <= n)),
                    lambda x: F.date_add(F.add_months(zero, x["k"]), (n - x["n"] + 12).cast("int")))

    def permuted(day: Column) -> Column:
        n = F.datediff(day, zero) - 12 * (F.year(day) * 12 + F.month(day) - F.lit(1900 * 12 + 1)) - 12
        window, rest = F.floor(n / span).cast("int"), F.pmod(n, F.lit(span))
        parts = F.array(F.floor(rest / LATE_DAYS[1]).cast("int"), (rest % LATE_DAYS[1]).cast("int"))
        return _let(feistel(parts, F.array(*map(F.lit, LATE_DAYS)), salt), lambda v: _let(
            window * span + v[0] * LATE_DAYS[1] + v[1], lambda i: F.date_format(late_day(i), "dd/MM/yyyy")))

    return _let(F.try_to_date(m, "dd/MM/yyyy"), lambda d: F.when(
        F.year(d).between(FIRST_YEAR, LAST_YEAR) & (F.day(d) > 12), permuted(d)).otherwise(m))


def _national(body: Column, salt: Column) -> Column:
    """The digits of a number without its country code.  Ten digits are read as
    a North American number wherever they stand: area and exchange begin with
    2 to 9, and where one does not both first digits stay."""
    def permuted(digits: Column) -> Column:
        whole = _within(body, [2, 0, 2, 0], [8, 100, 8, 1_000_000], [1, 2, 1, 6], salt)
        rest = F.concat(F.substring(digits, 2, 2), F.substring(digits, 5, 6))
        kept = _let(_within(rest, [0, 0], [100, 1_000_000], [2, 6], salt), lambda r: _put_back(
            body, "[0-9]", F.filter(F.split(F.concat(F.substring(digits, 1, 1), F.substring(r, 1, 2),
                                                     F.substring(digits, 4, 1), F.substring(r, 3, 6)), ""),
                                    lambda c: c != "")))
        ten = F.char_length(digits) == 10
        return F.when(ten & digits.rlike("^[2-9]..[2-9]"), whole).when(ten, kept).otherwise(characters(body, salt))
    return _let(F.regexp_replace(body, "[^0-9]", ""), permuted)


def _ssn(m: Column, salt: Column) -> Column:
    """An issued number: area 001 to 899 without 666, group and serial not 0."""
    area = F.substring(m, 1, 3).cast("int")
    group, serial = F.substring(m, 5, 2).cast("int"), F.substring(m, 8, 4).cast("int")
    place = area - F.when(area > 666, 2).otherwise(1)
    valid = area.between(1, 899) & (area != 666) & (group > 0) & (serial > 0)
    return F.when(valid, _let(
        feistel(F.array(place, group - 1, serial - 1), F.array(F.lit(898), F.lit(99), F.lit(9999)), salt),
        lambda v: F.concat_ws("-", F.lpad((v[0] + F.when(v[0] >= 665, 2).otherwise(1)).cast("string"), 3, "0"),
                              F.lpad((v[1] + 1).cast("string"), 2, "0"),
                              F.lpad((v[2] + 1).cast("string"), 4, "0")))).otherwise(m)


def pseudonym(m: Column, key: str = KEY) -> Column:
    """The pseudonym of one match."""
    salt = lambda kind: F.lit(hashlib.sha256(f"{key}|{kind}".encode()).hexdigest())
    whole = lambda p: m.rlike(f"^(?:{p})$")     # noqa: E731
    local = F.substring_index(m, "@", 1)
    country = F.regexp_extract(m, r"^\+?\d{1,3}[ .-]?(?=\()", 0)
    out = F.when(m.contains("@"), F.concat(_let(local, lambda x: characters(x, salt("mail"))),
                                           F.substring(m, F.char_length(local) + 1, F.char_length(m))))
    out = out.when(whole(ACCESS_KEY), _after(m, F.lit("AKIA"), lambda rest: characters(rest, salt("key"))))
    for pattern, fmt in DATE_FORMATS.items():
        dates = _date(m, salt("date"), fmt)
        if fmt == "MM/dd/yyyy":
            dates = F.when(F.try_to_date(m, fmt).isNull(), _late_date(m, salt("late"))).otherwise(dates)
        out = out.when(whole(DATE) & m.rlike(pattern), dates)
    out = out.when(whole(SSN), _ssn(m, salt("ssn")))
    out = out.when(whole(PHONE), _after(m, country, lambda rest: _national(rest, salt("phone"))))
    abroad = F.regexp_extract(m, rf"^\+{_CODE}{_TRUNK}[ ./-]?", 0)
    out = out.when(whole(INTERNATIONAL), _after(m, abroad, lambda rest: _national(rest, salt("phone"))))
    out = out.when(whole(UNSEPARATED), _after(
        m, F.substring(m, F.lit(1), F.char_length(m) - 10), lambda rest: _national(rest, salt("phone"))))
    out = out.when(whole(IPV4), _ipv4(m, salt("ip")))
    out = out.when(whole(HEX_KEY), characters(m, salt("hex"), hexadecimal=True))
    return out.when(whole(CARD), _card(m, salt("card"))).otherwise(m)


def _masked(text: Column, key: str) -> Column:
    """``(text, n_found)`` of one text."""
    found = F.when(text.rlike(MAY_HOLD), F.regexp_extract_all(text, F.lit(ANY), F.lit(0)))

    def joined(ms: Column) -> Column:
        gaps = F.split(text, ANY, -1)
        return F.when(F.coalesce(F.size(ms), F.lit(0)) > 0, F.struct(
            F.array_join(F.zip_with(gaps, ms, lambda g, m: F.concat(
                g, F.coalesce(pseudonym(m, key), F.lit("")))), "").alias("text"),
            F.size(ms).cast("long").alias("n"))).otherwise(
            F.struct(text.alias("text"), F.lit(0).cast("long").alias("n")))
    return _let(found, joined)


def mask(docs: DataFrame, text_col: str = "text", key: str = KEY, count_col: str | None = None) -> DataFrame:
    """The rows with pseudonyms in place of personal data, all columns kept;
    ``count_col`` names a further column with the number of matches."""
    out = _masked(docs[quoted(text_col)], key)
    if count_col is None:
        return docs.select(*[out["text"].alias(c) if c == text_col else docs[quoted(c)] for c in docs.columns])
    names = [quoted(c) for c in docs.columns if c not in (text_col, count_col)]
    both = unused("_masked", docs.columns)
    return (docs.select(*names, out.alias(both))
            .select(*names, F.col(f"{both}.text").alias(text_col), F.col(f"{both}.n").alias(count_col)))


def op4_pii(spark, d):
    docs = spark.read.parquet(f"{d}/documents.parquet").select("doc_id", "text")
    return mask(docs, count_col="n_found")


QUERIES = {"op4_pii": op4_pii}
ORACLE: dict[str, str] = {}
