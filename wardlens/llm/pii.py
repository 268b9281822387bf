"""Pseudonyms for personal data by format-preserving Feistel permutation.

Candidates are found by one pattern, validated, and replaced in place by built-in
functions only: card numbers (13 to 19 digits with a right Luhn digit), phone
numbers, social security numbers, dates of the calendar and IPv4 addresses are
permuted within their format by a keyed Feistel network, so the pseudonym is
again a valid value of that format, two values never share one, and equal values
stay equal in every document. The local part of an e-mail address becomes a keyed
digest at a reserved domain.

A value of a + b digits is a pair (left, right); round i adds a keyed digest of
one half to the other, modulo the size of its range. Ranges need not be equal.
The Luhn digit is computed anew. ``restore`` runs the rounds backwards.

A day of the calendar (1800-01-01 to 2199-12-31) has one pseudonym, however it
is written: the 57,600 = 240 x 240 days up to the 12th of a month are permuted
among themselves, and so are the 88,497 = 9 x 9,833 later ones, so a day that is
written with day and month in the other order, which only the later ones can be,
still reads as itself. Phone numbers of the North American plan, with area and
exchange from 200 to 999, are permuted within it; ten digits that do not fit the
plan keep the first digits of area and exchange.

Phone numbers have ten digits, (415) 555-2671 or in groups of 3, 3 and 4, with or
without country code, or a plus sign and 7 to 15 digits, whose country code is
kept; such a number takes the groups that follow it up to 15 digits. Dates are
year first, or 12/31/1999 with slashes and 31.12.1999 or 31-12-1999 otherwise; if
that is no date, day and month change places. A time may follow. Cards are digits in a row or in groups of 4-4-4-4, 4-6-5 or 4-6-4.

Numbers that fail validation are left alone, as is all other text.

Defined cases: null text stays null with no findings; empty text stays empty;
texts of any length are treated whole; rows are independent, so repeated ids and
extra columns (also named like the counts: they are replaced) do no harm.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

KEY = "wardlens-pseudonym-key"  # a parameter: use a secret one
ROUNDS = 10
KINDS = ["email", "ip", "phone", "ssn", "date", "card"]

# Matched from the start of a run only and without going back: a long run costs
# one pass.
_EMAIL = (r"(?<![A-Za-z0-9._+-])[A-Za-z0-9._+-]++@[A-Za-z0-9-]{1,63}(?:\.[A-Za-z0-9-]{1,63}){0,8}"
          r"\.[A-Za-z]{2,63}")
_OCTET = r"(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
_IP = rf"(?<![0-9A-Za-z.]){_OCTET}(?:\.{_OCTET}){{3}}(?!\.?[0-9A-Za-z])"
_DAY = r"(?:[0-9]{4}[-/.][0-9]{2}[-/.][0-9]{2}|[0-9]{2}[-/.][0-9]{2}[-/.][0-9]{4})(?![0-9])"
_PHONE = (r"(?<![0-9A-Za-z+])\+1[ .-]?(?:\([0-9]{3}\)|[0-9]{3})[ .-]?[0-9]{3}[ .-]?[0-9]{4}(?![0-9A-Za-z])"
          rf"|(?<![0-9A-Za-z+])\+(?!1)[1-9](?:[ .()-]{{0,2}}(?!(?<= ){_DAY})[0-9]){{6,14}}(?![0-9A-Za-z])"
          r"|(?:(?<![0-9A-Za-z+])\+[0-9]{1,3}[ .-]?)?(?<![0-9A-Za-z])(?:\([0-9]{3}\) ?[0-9]{3}[ .-][0-9]{4}"
          rf"|[0-9]{{3}}[ .-][0-9]{{3}}(?:[.-]| (?!{_DAY}))[0-9]{{4}})(?![0-9A-Za-z])")
# Country codes of one and two digits; all others have three (fixed values).
_COUNTRY = r"^(?:[17]|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58]|[0-9]{3})"
_SSN = r"(?<![0-9A-Za-z-])(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}(?![0-9A-Za-z-])"
_DATE = (r"(?<![0-9A-Za-z./-])(?:[0-9]{4}([-/.])[0-9]{2}\1[0-9]{2}"
         r"|[0-9]{2}([-/.])[0-9]{2}\2[0-9]{4})(?:(?=[Tt][0-9]{2}:?[0-9]{2})|(?![0-9A-Za-z/-]))")
_CARD = (r"(?<![0-9A-Za-z])(?:[0-9]{4}([ -])(?:[0-9]{4}\3[0-9]{4}\3[0-9]{4}|[0-9]{6}\3[0-9]{4,5})"
         r"|[0-9]{13,19})(?![0-9A-Za-z])")
PATTERN = "|".join([_EMAIL, _IP, _PHONE, _SSN, _DATE, _CARD])
# Texts without any of these hold no candidate.
_HINT = r"@|[0-9]{4}|[0-9]\.[0-9]|\+[1-9]"

_EPOCH, _MONTHS = "1800-01-01", 4800
# Days up to the 12th of a month, and those after it.
_EARLY_LEFT, _EARLY_RIGHT = 240, 240
_LATE_LEFT, _LATE_RIGHT = 9, 9833
# Areas and exchanges of the North American plan: 200 to 999 each.
_PLAN = 800


def _digits(x: Column) -> Column:
    return F.regexp_replace(x, "[^0-9]", "")


def _power(n: Column) -> Column:
    """10 ** n, exact for the lengths of halves."""
    return F.element_at(F.array(*[F.lit(10 ** i).cast("long") for i in range(11)]),
                        n.cast("int") + 1)


def luhn_sum(digits: Column, first_doubled: int) -> Column:
    """Sum of the digits; from the right, every second one is doubled, from
    position ``first_doubled`` (0 or 1) on, less 9 above 9."""
    n = F.char_length(digits)
    at = F.sequence(F.lit(1), n)

    def value(i):
        d = F.substr(digits, i, F.lit(1)).cast("int")
        twice = d * 2 - F.when(d > 4, 9).otherwise(0)
        return F.when(F.pmod(n - i, F.lit(2)) == first_doubled, twice).otherwise(d)

    return F.aggregate(at, F.lit(0), lambda t, i: t + value(i))


def _round_value(key: str, kind: Column, i: Column, half: Column, size: Column) -> Column:
    digest = F.sha2(F.concat_ws("|", F.lit(key), kind, i.cast("string"), half.cast("string")), 256)
    return F.pmod(F.conv(F.substr(digest, F.lit(1), F.lit(15)), 16, 10).cast("long"), size)


def feistel(key: str, kind: Column, left: Column, right: Column, left_size: Column,
            right_size: Column, forward: bool = True) -> Column:
    """struct(l, r): the keyed permutation of a pair in its ranges, or the
    inverse."""
    start = F.struct(left.cast("long").alias("l"), right.cast("long").alias("r"))
    order = F.sequence(F.lit(1), F.lit(ROUNDS)) if forward else F.sequence(F.lit(ROUNDS), F.lit(1))
    sign = 1 if forward else -1

    def step(acc, i):
        moved_l = F.pmod(acc["l"] + sign * _round_value(key, kind, i, acc["r"], left_size), left_size)
        moved_r = F.pmod(acc["r"] + sign * _round_value(key, kind, i, acc["l"], right_size), right_size)
        odd = F.pmod(i, F.lit(2)) == 1
        return F.struct(F.when(odd, moved_l).otherwise(acc["l"]).alias("l"),
                        F.when(odd, acc["r"]).otherwise(moved_r).alias("r"))

    return F.aggregate(order, start, step)


def _date_value(x: Column, turned: bool = False) -> Column:
    """The date that x names, null if the calendar has none; turned: with day
    and month in each other's place, which a year first does not admit."""
    d = _digits(x)
    iso = x.rlike("^[0-9]{4}")
    slash = F.contains(x, F.lit("/")) != F.lit(turned)
    part = lambda at, n: F.substr(d, F.lit(at), F.lit(n))
    year = F.when(iso, part(1, 4)).otherwise(part(5, 4))
    # Day and month: 31.12.1999, but 12/31/1999.
    month = F.when(iso, part(5, 2)).when(slash, part(1, 2)).otherwise(part(3, 2))
    day = F.when(iso, part(7, 2)).when(slash, part(3, 2)).otherwise(part(1, 2))
    date = F.try_to_timestamp(F.concat_ws("-", year, month, day), F.lit("yyyy-MM-dd")).cast("date")
    within = date.between(F.lit(_EPOCH).cast("date"), F.lit("2199-12-31").cast("date"))
    return F.when(within & ~iso if turned else within, date)


def _late_number(date: Column) -> Column:
    """The number of a date among the days after the 12th of a month."""
    months = (F.year(date) - int(_EPOCH[:4])) * 12 + F.month(date)
    return F.datediff(date, F.lit(_EPOCH).cast("date")) - 12 * months


def _late_date(number: Column) -> Column:
    """The inverse of ``_late_number``."""
    epoch = F.lit(_EPOCH).cast("date")
    near = F.floor(number * _MONTHS / (_LATE_LEFT * _LATE_RIGHT)).cast("int")
    month = F.array_max(F.filter(
        F.sequence(near - 2, near + 2),
        lambda m: F.datediff(F.add_months(epoch, m), epoch) - 12 * m <= number))
    return F.date_add(epoch, (number + 12 * (month + 1)).cast("int"))


def _early_number(date: Column) -> Column:
    """The number of a date among the days up to the 12th of a month."""
    return ((F.year(date) - int(_EPOCH[:4])) * 12 + F.month(date) - 1) * 12 + F.dayofmonth(date) - 1


def _early_date(number: Column) -> Column:
    """The inverse of ``_early_number``."""
    month = F.add_months(F.lit(_EPOCH).cast("date"), F.floor(number / 12).cast("int"))
    return F.date_add(month, F.pmod(number, F.lit(12)).cast("int"))


def kind_of(x: Column) -> Column:
    """The kind of a candidate, null if it does not validate."""
    whole = lambda p: x.rlike(f"^(?:{p})$")
    return (F.when(F.contains(x, F.lit("@")), "email")
            .when(whole(_IP), "ip")
            .when(whole(_PHONE), "phone")
            .when(whole(_SSN), "ssn")
            .when(whole(r"[0-9]{2,4}[-/.][0-9]{2}[-/.][0-9]{2,4}"),
                  F.when(_date_value(x).isNotNull() | _date_value(x, turned=True).isNotNull(), "date"))
            .when(F.pmod(luhn_sum(_digits(x), 1), F.lit(10)) == 0, "card"))


def _halved(f: Column) -> Column:
    """Adds the pair (l, r) of a value, its ranges (a, b), and the number of
    digits of its left half, if it is a digit string."""
    x, kind, d, body = f["x"], f["kind"], f["d"], f["body"]
    n = F.char_length(body)
    half = F.floor(n / 2).cast("int")
    octets = F.transform(F.split(x, r"\."), lambda o: F.try_to_number(o, F.lit("999")).cast("long"))
    # Areas 001-665 and 667-899, groups 01-99, serials 0001-9999.
    area = F.substr(d, F.lit(1), F.lit(3)).cast("int")
    ssn = ((area - F.when(area > 666, 2).otherwise(1)) * 99
           + F.substr(d, F.lit(4), F.lit(2)).cast("int") - 1)

    def digits(at: int, n: int) -> Column:
        return F.substr(body, F.lit(at), F.lit(n)).cast("int")

    def pair(l, r, a, b, n) -> Column:
        return F.struct(l.cast("long").alias("l"), r.cast("long").alias("r"),
                        a.cast("long").alias("a"), b.cast("long").alias("b"),
                        n.cast("int").alias("n"))

    return (F.when(kind == "ip", pair(octets[0] * 256 + octets[1], octets[2] * 256 + octets[3],
                                      F.lit(65536), F.lit(65536), F.lit(0)))
            .when((kind == "date") & f["late"],
                  pair(F.floor(f["days"] / _LATE_RIGHT), F.pmod(f["days"], F.lit(_LATE_RIGHT)),
                       F.lit(_LATE_LEFT), F.lit(_LATE_RIGHT), F.lit(0)))
            .when(kind == "date", pair(F.floor(f["days"] / _EARLY_RIGHT),
                                       F.pmod(f["days"], F.lit(_EARLY_RIGHT)),
                                       F.lit(_EARLY_LEFT), F.lit(_EARLY_RIGHT), F.lit(0)))
            .when(kind == "ssn", pair(ssn, F.substr(d, F.lit(6), F.lit(4)).cast("int") - 1,
                                      F.lit(898 * 99), F.lit(9999), F.lit(0)))
            .when((kind == "phone") & f["planned"], pair(
                (digits(1, 3) - 200) * _PLAN + digits(4, 3) - 200, digits(7, 4),
                F.lit(_PLAN * _PLAN), F.lit(10_000), F.lit(6)))
            .when((kind == "phone") & f["national"], pair(
                digits(2, 2) * 100 + digits(5, 2), digits(7, 4), F.lit(10_000), F.lit(10_000), F.lit(6)))
            .when(kind.isin("card", "phone"),
                  pair(F.substr(body, F.lit(1), half), F.substr(body, half + 1, n - half),
                       _power(half), _power(n - half), half)))


def _written(f: Column) -> Column:
    """The new digits of a permuted pair, or the whole new address."""
    x, kind, moved = f["x"], f["kind"], f["moved"]
    pad = lambda c, n: F.lpad(c.cast("string"), n, F.lit("0"))
    left = pad(moved["l"], f["pair"]["n"])
    old = F.right(f["d"], F.lit(10))
    left = F.when(f["planned"], F.concat(pad(F.floor(moved["l"] / _PLAN) + 200, F.lit(3)),
                                         pad(F.pmod(moved["l"], F.lit(_PLAN)) + 200, F.lit(3)))).when(
        f["national"], F.concat(
            F.substr(old, F.lit(1), F.lit(1)), pad(F.floor(moved["l"] / 100), F.lit(2)),
            F.substr(old, F.lit(4), F.lit(1)), pad(F.pmod(moved["l"], F.lit(100)), F.lit(2)))).otherwise(left)
    body = F.concat(left, pad(moved["r"], F.char_length(f["pair"]["b"].cast("string")) - 1))
    turned = f["turned"]
    date = F.when(f["late"], _late_date(moved["l"] * _LATE_RIGHT + moved["r"])).otherwise(
        _early_date(moved["l"] * _EARLY_RIGHT + moved["r"]))
    dated = (F.when(x.rlike("^[0-9]{4}"), F.date_format(date, "yyyyMMdd"))
             .when(F.contains(x, F.lit("/")) != turned, F.date_format(date, "MMddyyyy"))
             .otherwise(F.date_format(date, "ddMMyyyy")))
    area = F.floor(moved["l"] / 99) + 1
    ssn = F.concat(pad(area + F.when(area >= 666, 1).otherwise(0), F.lit(3)),
                   pad(F.pmod(moved["l"], F.lit(99)) + 1, F.lit(2)), pad(moved["r"] + 1, F.lit(4)))
    address = F.concat_ws(".", *[c.cast("string") for half in ("l", "r") for c in (
        F.floor(moved[half] / 256), F.pmod(moved[half], F.lit(256)))])
    country = F.substr(f["d"], F.lit(1), F.char_length(f["d"]) - f["pair"]["n"]
                       - F.char_length(f["pair"]["b"].cast("string")) + 1)
    return (F.when(kind == "ip", address).when(kind == "date", dated).when(kind == "ssn", ssn)
            .when(kind == "card", body).when(kind == "phone", F.concat(country, body)))


def _with_check(f: Column) -> Column:
    check = F.pmod(10 - F.pmod(luhn_sum(f["digits"], 0), F.lit(10)), F.lit(10))
    return F.when(f["kind"] == "card", F.concat(f["digits"], check.cast("string"))).otherwise(f["digits"])


def _laid_out(f: Column) -> Column:
    """The new digits in the places of the value's digits."""
    x = f["x"]

    def char(i):
        c = F.substr(x, i, F.lit(1))
        at = F.char_length(_digits(F.substr(x, F.lit(1), i)))
        return F.when(c.rlike("[0-9]"), F.substr(f["digits"], at, F.lit(1))).otherwise(c)

    return F.array_join(F.transform(F.sequence(F.lit(1), F.char_length(x)), char), "")


def _mail(x: Column, key: str) -> Column:
    digest = F.sha2(F.concat_ws("|", F.lit(key), F.lit("email"), F.lower(x)), 256)
    return F.concat(F.lit("p"), F.substr(digest, F.lit(1), F.lit(16)), F.lit("@mail.invalid"))


def _fields(f: Column, *names: str, **added: Column) -> Column:
    return F.struct(*[f[n].alias(n) for n in names], *[c.alias(n) for n, c in added.items()])


def pseudonyms(candidates: Column, key: str = KEY, forward: bool = True) -> Column:
    """array<struct(kind, new)> of an array of candidates; what does not
    validate has no kind and stays. Each step adds to the structs of the one
    before, so no expression is repeated."""
    found = F.transform(candidates, lambda x: F.struct(
        x.alias("x"), kind_of(x).alias("kind"), _digits(x).alias("d")))
    found = F.transform(found, lambda f: _fields(
        f, "x", "kind", "d",
        body=F.when(f["kind"] == "card", F.substr(f["d"], F.lit(1), F.char_length(f["d"]) - 1))
        .when(f["x"].rlike(r"^\+(?!1)[1-9]"), F.regexp_replace(f["d"], _COUNTRY, ""))
        .otherwise(F.right(f["d"], F.lit(10))),
        plain=F.when(f["kind"] == "date", _date_value(f["x"])),
        turned=F.when(f["kind"] == "date", _date_value(f["x"], turned=True))))
    found = F.transform(found, lambda f: _fields(
        f, "x", "kind", "d", "body", turned=(f["kind"] == "date") & f["plain"].isNull(),
        date=F.coalesce(f["plain"], f["turned"]),
        late=F.dayofmonth(F.coalesce(f["plain"], f["turned"])) > 12,
        national=(f["kind"] == "phone") & ~f["x"].rlike(r"^\+(?!1)[1-9]"),
        planned=(f["kind"] == "phone") & ~f["x"].rlike(r"^\+(?!1)[1-9]")
        & f["body"].rlike("^[2-9][0-9]{2}[2-9]")))
    kept = ["x", "kind", "d", "turned", "late", "national", "planned"]
    found = F.transform(found, lambda f: _fields(
        f, *kept, "body",
        days=F.when(f["late"], _late_number(f["date"])).otherwise(_early_number(f["date"]))))
    found = F.transform(found, lambda f: _fields(f, *kept, pair=_halved(f)))
    found = F.transform(found, lambda f: _fields(
        f, *kept, "pair", moved=F.when(f["pair"].isNotNull(), feistel(
            key, f["kind"], f["pair"]["l"], f["pair"]["r"], f["pair"]["a"], f["pair"]["b"], forward))))
    found = F.transform(found, lambda f: _fields(f, "x", "kind", digits=_written(f)))
    found = F.transform(found, lambda f: _fields(f, "x", "kind", digits=_with_check(f)))
    mail = (lambda x: _mail(x, key)) if forward else (lambda x: x)
    return F.transform(found, lambda f: _fields(
        f, "kind", new=F.when(f["kind"].isNull(), f["x"]).when(f["kind"] == "email", mail(f["x"]))
        .when(f["kind"] == "ip", f["digits"]).otherwise(_laid_out(f))))


def pseudonymise(rows: DataFrame, text_col: str = "text", key: str = KEY,
                 forward: bool = True) -> DataFrame:
    """``rows`` with the text's personal data replaced, and n_email, n_ip,
    n_phone, n_ssn, n_date and n_card, the numbers of replaced values."""
    text = F.col(text_col)
    state = "__pii"
    while state in rows.columns:
        state += "_"
    candidates = F.regexp_extract_all(text, F.lit(PATTERN), F.lit(0))
    with_found = rows.withColumn(state, F.when(text.rlike(_HINT), pseudonyms(candidates, key, forward)))
    found = F.col(state)
    new = F.transform(found, lambda f: f["new"])
    joined = F.array_join(F.zip_with(F.split(text, PATTERN), F.concat(new, F.array(F.lit(""))),
                                     lambda a, b: F.concat(a, b)), "")
    kinds = F.array_compact(F.transform(found, lambda f: f["kind"]))
    counts = {f"n_{kind}": F.when(found.isNull(), 0).otherwise(
        F.size(kinds) - F.size(F.array_remove(kinds, kind))).cast("long") for kind in KINDS}
    # Texts without a replaced value are passed on as they are.
    text_out = F.when(F.size(kinds) > 0, joined).otherwise(text)
    return with_found.withColumns({text_col: text_out} | counts).drop(state)


def restore(rows: DataFrame, text_col: str = "text", key: str = KEY) -> DataFrame:
    """Undo ``pseudonymise`` for all but e-mail addresses, whose digests have
    no inverse."""
    return pseudonymise(rows, text_col, key, forward=False)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op2: all documents."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return pseudonymise(docs)
