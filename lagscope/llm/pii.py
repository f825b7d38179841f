"""Pseudonyms for personal numbers and dates that keep their format.

Values are found by pattern and validated: card numbers by their check digit, phone
numbers by their numbering plan, addresses by their range, dates by the calendar.
A value is read as symbols, each with a radix, and goes through a keyed Feistel
network over them: the symbols are split in halves, and in each round every symbol
of one half is moved, modulo its radix, by a hash of the key and the other half.
That is a permutation of all values of the format, so different values stay
different and equal values are equal in every document, however they are written.
Days are one set of values in all their formats.

No pattern repeats a group without a bound or tries the same text in two ways, so that
a text takes time in proportion to its length whatever it holds.

All of it is column expressions: a text is split at the values and put together
again. Nothing is shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: For tests and examples; a real run passes its own secret.
KEY = "example key"
ROUNDS = 8

_BEFORE = r"(?<![0-9A-Za-z_])"
_AFTER = r"(?![0-9A-Za-z_])"
#: A local part has 64 characters at most, a label of the domain 63, and it has up to 126.
EMAIL = r"(?<![.%+-])[0-9A-Za-z][0-9A-Za-z._%+-]{0,63}+@(?:[0-9A-Za-z-]{1,63}+\.){1,126}[A-Za-z]{2,63}"
#: +1 (212) 555-0100, (212) 555-0100, 212-555-0100, 212.555.0100 and the like.
PHONE = r"(?:\+?1[ .-]?)?(?:\([2-9][0-9]{2}\) ?|[2-9][0-9]{2}[ .-])[2-9][0-9]{2}[ .-][0-9]{4}"
#: Numbers beyond those: area codes from 0 or 1 behind +1 with brackets, ten digits
#: without separators, and others with + and a country's number.
AREA_01 = r"\+1[ .-]?\([01][0-9]{2}\) ?[2-9][0-9]{2}[ .-][0-9]{4}"
#: Ten bare digits may be any number: they are one of a phone behind +1 or a word that says so.
CUE = r"(?<=(?i:\b(?:call|calls|cell|dial|fax|mobile|phone|ph|tel|telephone|text|whatsapp)[.:]{0,2}[ \t]{0,2}(?:at |no\.? |number |# ?)?))"
_TEN = r"(?:\+?1)?[2-9][0-9]{2}[2-9][0-9]{6}"
PLAIN = rf"(?:\+1[2-9][0-9]{{2}}[2-9][0-9]{{6}}|{CUE}1?[2-9][0-9]{{2}}[2-9][0-9]{{6}})"
ABROAD = r"\+[2-9](?:[ .-]?[(]?[0-9][)]?){7,14}"
DATE = (
    r"(?:(?:19|20)[0-9]{2}-[0-9]{2}-[0-9]{2}|[0-9]{2}\.[0-9]{2}\.(?:19|20)[0-9]{2}"
    r"|[0-9]{2}/[0-9]{2}/(?:19|20)[0-9]{2}"
    r"|(?<![0-9][./])(?:[0-9]{1,2}\.[0-9]{1,2}\.|[0-9]{1,2}/[0-9]{1,2}/)(?:19|20)[0-9]{2})"
)
_OCTET = r"(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[1-9]?[0-9])"
ADDRESS = rf"(?<![0-9]\.){_OCTET}(?:\.{_OCTET}){{3}}(?!\.[0-9])"
#: Social security numbers.
SSN = r"(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}"
CARD = r"(?:[0-9]{4}(?:[ -][0-9]{4}){3}|[0-9]{4}[ -][0-9]{6}[ -][0-9]{5}|[0-9]{13,19})"

#: An @, or a digit with enough digits near: what the patterns need.
_HINT = r"@|[0-9][0-9 .()/-]{4,}[0-9]"


def _whole(pattern: str) -> str:
    return f"^(?:{pattern})$"


ANY = f"{_BEFORE}(?:{EMAIL}|{DATE}|{ADDRESS}|{SSN}|{CARD})(?<![.-]){_AFTER}"
#: A phone number may begin with a sign or a bracket.
ANY = f"(?:{ANY}|(?<![0-9A-Za-z_+(])(?:{PHONE}|{AREA_01}|{PLAIN}|{ABROAD}){_AFTER})"


def feistel(values: Column, radixes: Column, key: str, kind: str | Column, rounds: int = ROUNDS) -> Column:
    """``values``, numbers each below its radix, permuted within their radixes.

    With one symbol only there is no other half; it is then moved by the key alone.
    """
    half = F.floor(F.size(values) / 2).cast("int")
    count = F.size(values)
    start = F.struct(
        F.slice(values, 1, half).alias("a"),
        F.slice(values, half + 1, count).alias("b"),
        F.slice(radixes, 1, half).alias("ra"),
        F.slice(radixes, half + 1, count).alias("rb"),
    )

    def one(s: Column, i: Column) -> Column:
        seed = F.concat_ws("|", F.lit(key), kind if isinstance(kind, Column) else F.lit(kind), i.cast("string"), F.array_join(s["a"], ","))

        def moved(v: Column, at: Column) -> Column:
            hashed = F.md5(F.concat_ws("|", seed, at.cast("string")).cast("binary"))
            shift = F.conv(F.substring(hashed, 1, 12), 16, 10).cast("long")
            return F.pmod(v + shift, F.get(s["rb"], at))

        # The halves change places: the moved one is the other half's seed next.
        return F.struct(
            F.transform(s["b"], moved).alias("a"), s["a"].alias("b"), s["rb"].alias("ra"), s["ra"].alias("rb")
        )

    def joined(s: Column) -> Column:
        return F.concat(s["a"], s["b"])

    # An even number of rounds leaves the halves in their places.
    return F.aggregate(F.sequence(F.lit(1), F.lit(rounds)), start, one, joined)


def _digits(x: Column) -> Column:
    return F.transform(F.split(F.regexp_replace(x, "[^0-9]", ""), ""), lambda c: c.cast("long"))


def _numbers(*values: int) -> Column:
    return F.array(*[F.lit(v).cast("long") for v in values])


def _refilled(x: Column, digits: Column) -> Column:
    """The digits of ``x``, from the right, replaced by ``digits``; signs stay."""
    chars = F.split(x, "")

    def char(c: Column, at: Column) -> Column:
        to_right = F.char_length(F.regexp_replace(F.substring(x, at + 1, F.char_length(x)), "[^0-9]", ""))
        place = F.size(digits) - to_right
        return F.when(c.rlike("[0-9]") & (place >= 0), F.get(digits, place).cast("string")).otherwise(c)

    return F.array_join(F.transform(chars, char), "")


def _luhn(digits: Column) -> Column:
    """The check sum of digits, the last one being the check digit."""
    doubled = F.transform(
        F.reverse(digits),
        lambda d, at: F.when(at % 2 == 0, d).when(d > 4, 2 * d - 9).otherwise(2 * d),
    )
    return F.aggregate(doubled, F.lit(0).cast("long"), lambda a, d: a + d)


def _card(x: Column, key: str) -> Column:
    digits = _digits(x)
    payload = F.slice(digits, 1, F.size(digits) - 1)
    new = feistel(payload, F.transform(payload, lambda _: F.lit(10).cast("long")), key, "card")
    check = F.pmod(-_luhn(F.concat(new, _numbers(0))), F.lit(10))
    return F.when(_luhn(digits) % 10 == 0, _refilled(x, F.concat(new, F.array(check)))).otherwise(x)


def _phone(x: Column, key: str) -> Column:
    digits = F.slice(_digits(x), -10, 10)
    low = _numbers(2, 0, 0, 2, 0, 0, 0, 0, 0, 0)
    radixes = _numbers(8, 10, 10, 8, 10, 10, 10, 10, 10, 10)
    new = feistel(F.zip_with(digits, low, lambda d, o: d - o), radixes, key, "phone")
    return _refilled(x, F.zip_with(new, low, lambda d, o: d + o))


def _phone_01(x: Column, key: str) -> Column:
    """Area codes from 0 or 1 stay among themselves."""
    digits = F.slice(_digits(x), -10, 10)
    low = _numbers(0, 0, 0, 2, 0, 0, 0, 0, 0, 0)
    radixes = _numbers(2, 10, 10, 8, 10, 10, 10, 10, 10, 10)
    new = feistel(F.zip_with(digits, low, lambda d, o: d - o), radixes, key, "phone 01")
    return _refilled(x, F.zip_with(new, low, lambda d, o: d + o))


def _abroad(x: Column, key: str) -> Column:
    """All digits but the first two, which hold the country's number or its start."""
    digits = _digits(x)
    rest = F.slice(digits, 3, F.size(digits) - 2)
    kind = F.concat(F.lit("phone "), F.array_join(F.slice(digits, 1, 2), ""))
    start = F.transform(rest, lambda _: F.lit(10).cast("long"))
    new = _refilled(x, feistel(rest, start, key, kind))
    return F.when(F.size(digits).between(8, 15), new).otherwise(x)


def _ssn(x: Column, key: str) -> Column:
    parts = F.transform(F.split(x, "-"), lambda p: p.cast("long"))
    area = F.get(parts, F.lit(0))
    # 898 areas: 001 to 899 without 666.
    known = F.array(area - F.when(area > 666, 2).otherwise(1), F.get(parts, F.lit(1)) - 1, F.get(parts, F.lit(2)) - 1)
    new = feistel(known, _numbers(898, 99, 9999), key, "ssn")
    at = F.get(new, F.lit(0))
    return F.concat_ws(
        "-",
        F.lpad((at + F.when(at >= 665, 2).otherwise(1)).cast("string"), 3, "0"),
        F.lpad((F.get(new, F.lit(1)) + 1).cast("string"), 2, "0"),
        F.lpad((F.get(new, F.lit(2)) + 1).cast("string"), 4, "0"),
    )


def _address(x: Column, key: str) -> Column:
    octets = F.transform(F.split(x, r"\."), lambda o: o.cast("long"))
    return F.array_join(feistel(octets, _numbers(256, 256, 256, 256), key, "address"), ".")


_FIRST_DAY = "1900-01-01"
_MONTHS = 200 * 12
#: Days from the 13th on, of all months, and a format a little larger; a number that
#: falls outside the days goes through the permutation again.
_LATE_DAYS = 73_049 - 12 * _MONTHS
_LATE_FORMAT = (211, 210)
#: A number falls outside once in 700 times, so this many times in 10**22.
_AGAIN = 8


def _permuted_late(n: Column, key: str) -> Column:
    def one(v: Column, _: Column) -> Column:
        new = feistel(
            F.array(F.floor(v / _LATE_FORMAT[1]).cast("long"), F.pmod(v, F.lit(_LATE_FORMAT[1]).cast("long"))),
            _numbers(*_LATE_FORMAT), key, "late day",
        )
        return F.get(new, F.lit(0)) * _LATE_FORMAT[1] + F.get(new, F.lit(1))

    walk = lambda v, i: F.when((i > 1) & (v < _LATE_DAYS), v).otherwise(one(v, i))
    return F.aggregate(F.sequence(F.lit(1), F.lit(_AGAIN)), n, walk)


def _before(month: Column) -> Column:
    """Days from the 13th on in the months before one, which are counted from 1900."""
    first = F.add_months(F.lit(_FIRST_DAY).cast("date"), month.cast("int"))
    return F.date_diff(first, F.lit(_FIRST_DAY).cast("date")).cast("long") - 12 * month


def new_day(day: Column, key: str) -> Column:
    """The pseudonym of a day of 1900 to 2099. Days up to the 12th stay among themselves,
    and so do later ones: written with the day first, the former can be read with the
    month first, the latter can't, and neither may become the other."""
    first = F.lit(_FIRST_DAY).cast("date")
    month = ((F.year(day) - 1900) * 12 + F.month(day) - 1).cast("long")
    at = F.dayofmonth(day).cast("long")
    early = feistel(F.array(month, at - 1), _numbers(_MONTHS, 12), key, "early day")
    early_day = F.date_add(
        F.add_months(first, F.get(early, F.lit(0)).cast("int")), F.get(early, F.lit(1)).cast("int")
    )
    late = _permuted_late(_before(month) + at - 13, key)
    # The month is found near where it would be if all were of the same length.
    guess = F.floor(late * _MONTHS / _LATE_DAYS).cast("long")
    near = F.sequence(F.greatest(guess - 2, F.lit(0)), F.least(guess + 2, F.lit(_MONTHS - 1)))
    into = F.array_max(F.filter(near, lambda m: _before(m) <= late))
    late_day = F.date_add(F.add_months(first, into.cast("int")), (late - _before(into) + 12).cast("int"))
    return F.when(at <= 12, early_day).otherwise(late_day)


def _date(x: Column, key: str) -> Column:
    """Between slashes the month comes first if that is a date, else the day. One form
    stands for all lengths of writing, with days and months of two digits."""

    def read(form: str) -> Column:
        # Forms of one letter read days and months of one or two digits.
        return F.try_to_timestamp(x, F.lit(form)).cast("date")

    def written(day: Column, form: str) -> Column:
        return F.date_format(day, form)

    iso, dots, month_first, day_first = (read(f) for f in ("yyyy-MM-dd", "d.M.yyyy", "M/d/yyyy", "d/M/yyyy"))
    slashes = F.coalesce(month_first, day_first)
    form = F.when(x.rlike("^[0-9]{4}-"), F.struct(iso.alias("day"), F.lit("y").alias("form")))
    form = form.when(x.contains("."), F.struct(dots.alias("day"), F.lit("d").alias("form"))).otherwise(
        F.struct(slashes.alias("day"), F.when(month_first.isNull(), "s").otherwise("m").alias("form"))
    )
    # The day is worked out once, in an array of one.
    moved = F.transform(
        F.array(form),
        lambda f: F.struct(new_day(f["day"], key).alias("day"), f["form"].alias("form")),
    )
    texts = F.transform(
        moved,
        lambda f: F.when(f["form"] == "y", written(f["day"], "yyyy-MM-dd"))
        .when(f["form"] == "d", written(f["day"], "dd.MM.yyyy"))
        .when(f["form"] == "s", written(f["day"], "dd/MM/yyyy"))
        .otherwise(written(f["day"], "MM/dd/yyyy")),
    )
    return F.coalesce(F.get(texts, F.lit(0)), x)


def _email(x: Column, key: str) -> Column:
    """The local part, letters for letters and digits for digits; the domain stays."""
    local = F.substring_index(x, "@", 1)
    chars = F.split(local, "")
    radixes = F.transform(
        chars,
        lambda c: F.when(c.rlike("[0-9]"), 10).when(c.rlike("[A-Za-z]"), 26).otherwise(1).cast("long"),
    )
    values = F.transform(
        chars,
        lambda c: F.when(c.rlike("[0-9]"), F.ascii(c) - 48)
        .when(c.rlike("[A-Za-z]"), F.ascii(F.lower(c)) - 97)
        .otherwise(0)
        .cast("long"),
    )
    new = feistel(values, radixes, key, "email")

    def char(c: Column, v: Column) -> Column:
        return (
            F.when(c.rlike("[0-9]"), F.char(v + 48))
            .when(c.rlike("[a-z]"), F.char(v + 97))
            .when(c.rlike("[A-Z]"), F.char(v + 65))
            .otherwise(c)
        )

    return F.concat(F.array_join(F.zip_with(chars, new, char), ""), F.lit("@"), F.substring_index(x, "@", -1))


def pseudonym(x: Column, key: str) -> Column:
    """The pseudonym of a value that matches ``ANY``; what doesn't validate stays."""
    return (
        F.when(x.contains("@"), _email(x, key))
        .when(x.rlike(_whole(DATE)), _date(x, key))
        .when(x.rlike(_whole(ADDRESS)), _address(x, key))
        .when(x.rlike(_whole(SSN)), _ssn(x, key))
        .when(x.rlike(_whole(PHONE)), _phone(x, key))
        .when(x.rlike(_whole(AREA_01)), _phone_01(x, key))
        .when(x.rlike(_whole(_TEN)), _phone(x, key))
        .when(x.startswith("+"), _abroad(x, key))
        .when(x.rlike(_whole(CARD)), _card(x, key))
        .otherwise(x)
    )


def pseudonymise(docs: DataFrame, key: str = KEY) -> DataFrame:
    """``docs`` with pseudonyms in text, and n_values, the number of values replaced.

    Null and empty texts stay as they are. Equal rows give equal results; all other
    columns are kept, but for one named n_values, which is replaced. Passwords and
    keys are no personal numbers and stay.
    """
    text = F.col("text")
    found = F.transform(
        F.regexp_extract_all(text, F.lit(ANY), F.lit(0)),
        lambda x: F.struct(x.alias("old"), pseudonym(x, key).alias("new")),
    )
    hinted = F.coalesce(text.rlike(_HINT), F.lit(False))
    values = F.when(hinted, found).otherwise(F.array().cast("array<struct<old:string,new:string>>"))
    pieces = F.zip_with(
        F.split(text, ANY),
        F.col("_values.new"),
        lambda gap, new: F.concat(gap, F.coalesce(new, F.lit(""))),
    )
    return (
        docs.withColumn("_values", values)
        .withColumns(
            {
                "text": F.when(F.size("_values") > 0, F.array_join(pieces, "")).otherwise(text),
                "n_values": F.size(F.filter("_values", lambda v: v["old"] != v["new"])).cast("long"),
            }
        )
        .drop("_values")
    )


def pseudonym_texts(docs: DataFrame) -> DataFrame:
    return pseudonymise(docs.select("doc_id", "text"))
