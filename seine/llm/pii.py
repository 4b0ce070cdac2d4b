"""Format-preserving pseudonyms for personal data, as DataFrame expressions.

A value that passes its kind's check (Luhn, mod 97, octets, calendar, number plan) becomes a
vector of small integers, each with a radix: digits 10, letters 26, octets 256, and so on. A
keyed Feistel network adds to one half of the vector a digest of the other, position by
position modulo the radix, and swaps; that permutes the values of a format among themselves,
so equal values get equal pseudonyms in all documents, different ones stay different, and a
holder of the key can go back. Check digits are computed anew. Nothing is joined or looked up.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import let

ROUNDS = 8
#: Days of the Gregorian cycle from 1800-01-01 to 2199-12-31 are 189 x 773, so a date is two exact digits.
EPOCH, HIGH, LOW = "1800-01-01", 189, 773
#: Of these, 9 x 9833 are the 13th of a month or later, which is what a date with the day first must be to be told from one with the month first.
LATE_HIGH, LATE_LOW, LATE_DAYS, MONTHS = 9, 9833, 88497, 4800
#: Signs of an IBAN by country, by which its printed form in groups of four has an end.
IBAN_SIGNS = {
    15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH CR HR LI LV", 22: "BG BH DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG",
    25: "LY PT ST", 26: "IS TR", 27: "BI DJ FR GR IT MC MR SM", 28: "AL AZ BY CY DO GT HU LB NI PL SV", 29: "BR EG PS QA UA", 30: "JO KW MU YE", 31: "MT SC", 32: "LC", 33: "RU",
}
GROUPED = "|".join(f"(?:{names.replace(' ', '|')})[0-9]{{2}}(?: [A-Z0-9]{{4}}){{{n // 4 - 1}}}" + (f" [A-Z0-9]{{{n % 4}}}" if n % 4 else "") for n, names in IBAN_SIGNS.items())
#: North American numbers without a country; area and exchange start with 2 to 9, so each passes the number plan.
NATIONAL = r"(?<![0-9A-Za-z+])(?<![0-9][.-])(?:1[ .-])?(?:\([2-9][0-9]{2}\)[ .-]?|[2-9][0-9]{2}[ .-])[2-9][0-9]{2}[ .-][0-9]{4}(?![0-9])"
#: kind: where a value may stand. Each starts behind a sign that can't be part of it, so no stretch is tried twice.
PATTERNS = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+",
    "ip": r"(?<![0-9.])(?:[0-9]{1,3}\.){3}[0-9]{1,3}(?![0-9])(?!\.[0-9])",
    "ip6": r"(?<![0-9A-Za-z:.])(?:(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}|(?:[0-9A-Fa-f]{1,4}:){1,6}(?::[0-9A-Fa-f]{1,4}){1,6})(?![0-9A-Za-z:])(?!\.[0-9])",
    "phone": r"(?<![0-9+])\+[0-9]{1,3}[ .-]?\(?[0-9]{3}\)?[ .-]?[0-9]{3}[ .-]?[0-9]{4}(?![0-9])|" + NATIONAL,
    "date": r"(?<![0-9./-])(?:[0-9]{4}-[0-9]{2}-[0-9]{2}|[0-9]{2}\.[0-9]{2}\.[0-9]{4}|[0-9]{2}/[0-9]{2}/[0-9]{4})(?![0-9/-])",
    "ssn": r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
    "iban": rf"(?<![A-Za-z0-9])(?:[A-Z]{{2}}[0-9]{{2}}[A-Z0-9]{{11,30}}|{GROUPED})(?![A-Za-z0-9])",
    "card": r"(?<![0-9A-Za-z])[0-9](?:[ -]?[0-9]){12,18}(?![0-9A-Za-z])",
}
ANY = "|".join(PATTERNS.values())
KINDS = tuple(PATTERNS)
#: What every value holds, to pass over other texts cheaply.
HINT = r"[0-9@]"


def _chars(s: Column) -> Column:
    return F.when(F.length(s) == 0, F.array().cast("array<string>")).otherwise(F.transform(F.sequence(F.lit(1), F.length(s)), lambda i: F.substring(s, i, F.lit(1))))


def _digits(s: Column) -> Column:
    return F.regexp_replace(s, "[^0-9]", "")


def _north(digits: Column) -> Column:
    """Whether a phone's digits are of the North American plan: +1, or no country at all."""
    return ((F.length(digits) == 11) & digits.startswith("1")) | (F.length(digits) == 10)


def _sum(values: Column) -> Column:
    return F.aggregate(values, F.lit(0), lambda a, b: a + b)


def luhn_sum(digits: Column) -> Column:
    """Of a number's digits, the last one standing at an even place from the right."""
    return let(F.reverse(digits), lambda r: _sum(F.transform(_chars(r), lambda c, i: let(c.cast("int"), lambda d: F.when(i % 2 == 0, d).when(d > 4, 2 * d - 9).otherwise(2 * d)))))


def mod97(s: Column) -> Column:
    """Of digits and capitals, capitals as 10 to 35."""
    return F.aggregate(_chars(s), F.lit(0), lambda a, c: F.when(c >= "A", (a * 100 + F.ascii(c) - 55) % 97).otherwise((a * 10 + F.ascii(c) - 48) % 97))


def _day_first(m: Column) -> Column:
    """Whether a date with slashes has the day first, as its first number is no month."""
    return (m.substr(3, 1) == "/") & (m.substr(1, 2).try_cast("int") > 12)


def _date(m: Column) -> Column:
    """The day that a date names; null if there is none."""
    iso, dotted = m.substr(5, 1) == "-", (m.substr(3, 1) == ".") | _day_first(m)
    y = F.when(iso, m.substr(1, 4)).otherwise(m.substr(7, 4))
    month = F.when(iso, m.substr(6, 2)).when(dotted, m.substr(4, 2)).otherwise(m.substr(1, 2))
    day = F.when(iso, m.substr(9, 2)).when(dotted, m.substr(1, 2)).otherwise(m.substr(4, 2))
    return F.try_to_date(F.concat_ws("-", y, month, day), "yyyy-MM-dd")


def _late_before(month: Column) -> Column:
    """Days from the 13th on in the months of the cycle before one."""
    return F.datediff(F.add_months(F.lit(EPOCH).cast("date"), month), F.lit(EPOCH).cast("date")) - 12 * month


def _late_number(date: Column) -> Column:
    """The place of a day among the cycle's days from the 13th on."""
    return _late_before(((F.year(date) - 1800) * 12 + F.month(date) - 1).cast("int")) + F.day(date) - 13


def _late_date(number: Column) -> Column:
    near = F.floor(number * MONTHS / LATE_DAYS).cast("int")
    month = F.element_at(F.filter(F.sequence(near - 2, near + 2), lambda k: _late_before(k) <= number), -1)
    return let(month, lambda k: F.date_add(F.add_months(F.lit(EPOCH).cast("date"), k), (number - _late_before(k) + 12).cast("int")))


def _vector(values: Column, radices: Column) -> Column:
    return F.struct(values.cast("array<int>").alias("v"), radices.cast("array<int>").alias("r"))


def _of_chars(s: Column) -> Column:
    """Characters as digits 0-9 or letters 0-25; others stay, with radix 1."""
    value = F.transform(_chars(s), lambda c: F.when(c.between("0", "9"), F.ascii(c) - 48).when(c.between("A", "Z"), F.ascii(c) - 65).when(c.between("a", "z"), F.ascii(c) - 97).otherwise(0))
    radix = F.transform(_chars(s), lambda c: F.when(c.between("0", "9"), 10).when(c.between("A", "Z") | c.between("a", "z"), 26).otherwise(1))
    return _vector(value, radix)


def _to_chars(s: Column, v: Column) -> Column:
    letter = lambda base, i: F.char(F.lit(base) + F.get(v, i))
    return F.array_join(F.transform(_chars(s), lambda c, i: F.when(c.between("0", "9"), letter(48, i)).when(c.between("A", "Z"), letter(65, i)).when(c.between("a", "z"), letter(97, i)).otherwise(c)), "")


def _single(x: Column, key: Column, tweak: Column, back: bool) -> Column:
    """The permuted vector of one number, which has no other half: numbers take the places of their digests in order."""
    size = F.get(x["r"], 0)
    drawn = F.transform(F.sequence(F.lit(0), size - 1), lambda k: F.struct(F.sha2(F.concat_ws("|", key, tweak, F.lit("single"), size, k), 256).alias("h"), k.alias("k")))
    table = F.transform(F.sort_array(drawn), lambda d: d["k"])
    value = F.get(x["v"], 0)
    return F.array(((F.array_position(table, value) - 1) if back else F.get(table, value)).cast("int"))


def feistel(vector: Column, key: Column, tweak: Column, back: bool = False) -> Column:
    """The permuted vector; ``back`` undoes it. Half by turns gets a digest of the other half added; ``tweak`` tells formats apart."""

    def permuted(x: Column) -> Column:
        half = F.floor((F.size(x["v"]) + 1) / 2).cast("int")

        def turn(v: Column, number: Column) -> Column:
            mine = lambda i: (i < half) == (number % 2 == 0)
            other = F.array_join(F.filter(v, lambda _, i: ~mine(i)), ",")
            drawn = lambda o, i: F.conv(F.substring(F.sha2(F.concat_ws("|", key, tweak, number, F.size(v), i, o), 256), 1, 12), 16, 10).cast("long")
            return let(other, lambda o: F.transform(v, lambda one, i: F.when(mine(i), F.pmod(one - drawn(o, i) if back else one + drawn(o, i), F.get(x["r"], i)).cast("int")).otherwise(one)))

        rounds = reversed(range(ROUNDS)) if back else range(ROUNDS)
        return F.when(F.size(x["v"]) == 1, _single(x, key, tweak, back)).otherwise(F.aggregate(F.array(*map(F.lit, rounds)), x["v"], turn))

    return let(vector, permuted)


def kind_of(m: Column) -> Column:
    """The first kind whose pattern the whole match fits and whose check it passes; null if none does."""
    whole = lambda kind: m.rlike(f"^(?:{PATTERNS[kind]})$")
    digits = _digits(m)
    n = F.length(digits)
    national = lambda k: F.substring(digits, n - 10 + k, F.lit(1)).cast("int")
    checks = {
        "email": F.lit(True),
        "ip": F.forall(F.split(m, r"\."), lambda o: (o.cast("int") <= 255) & ((o == "0") | ~o.startswith("0"))),
        "ip6": m.rlike("[0-9]") & F.when(m.contains("::"), F.size(F.array_remove(F.split(m, ":"), "")) <= 7).otherwise(True),
        "phone": F.when(_north(digits), (national(1) >= 2) & (national(4) >= 2)).otherwise(True),
        "date": let(_date(m), lambda d: d.between("1800-01-01", "2199-12-31")),
        "ssn": (~m.substr(1, 3).isin("000", "666")) & (m.substr(1, 1) != "9") & (m.substr(5, 2) != "00") & (m.substr(8, 4) != "0000"),
        "iban": let(F.translate(m, " ", ""), lambda c: mod97(F.concat(F.substring(c, F.lit(5), F.length(c)), F.substring(c, 1, 4)))) == 1,
        "card": (luhn_sum(digits) % 10 == 0) & (digits.cast("decimal(38,0)") > 0),
    }
    out = F.when(F.lit(False), F.lit(""))
    for kind in KINDS:
        out = out.when(whole(kind), F.when(F.coalesce(checks[kind], F.lit(False)), F.lit(kind)))
    return out


def pseudonym(m: Column, kind: Column, key: Column, back: bool = False) -> Column:
    """The permuted value in its own format; the match itself where the kind is null."""
    digits = _digits(m)
    n = F.length(digits)
    at = F.instr(m, "@")
    local, host = F.substring(m, F.lit(1), at - 1), F.substring(m, at, F.length(m))
    inner = F.substring(digits, F.lit(2), n - 2)
    national = F.substring(digits, n - 9, F.lit(10))
    north = _north(digits)
    compact = F.translate(m, " ", "")
    own_bban = F.substring(compact, F.lit(5), F.length(compact))
    offset = lambda i: F.when(north & i.isin(0, 3), 2).otherwise(0)
    octets = F.transform(F.split(m, r"\."), lambda o: o.cast("int"))
    area = m.substr(1, 3).cast("int")
    day = F.datediff(_date(m), F.lit(EPOCH).cast("date"))
    late = _late_number(_date(m))
    hexes = let(_of_chars(m), lambda x: _vector(x["v"], F.transform(x["r"], lambda r: F.when(r == 26, 6).otherwise(r))))
    vector = (
        F.when(kind == "email", _of_chars(local))
        .when(kind == "ip", _vector(octets, F.array(*[F.lit(256)] * 4)))
        .when(kind == "ip6", hexes)
        .when(kind == "phone", _vector(F.transform(_chars(national), lambda c, i: c.cast("int") - offset(i)), F.transform(F.sequence(F.lit(0), F.lit(9)), lambda i: 10 - offset(i))))
        .when((kind == "date") & _day_first(m), _vector(F.array(F.floor(late / LATE_LOW), late % LATE_LOW), F.array(F.lit(LATE_HIGH), F.lit(LATE_LOW))))
        .when(kind == "date", _vector(F.array(F.floor(day / LOW), day % LOW), F.array(F.lit(HIGH), F.lit(LOW))))
        .when(kind == "ssn", _vector(F.array(area - F.when(area > 666, 2).otherwise(1), m.substr(5, 2).cast("int") - 1, m.substr(8, 4).cast("int") - 1), F.array(F.lit(898), F.lit(99), F.lit(9999))))
        .when(kind == "iban", _of_chars(own_bban))
        .otherwise(_of_chars(inner))
    )

    def written_as(v: Column) -> Column:
        date = F.date_add(F.lit(EPOCH).cast("date"), (F.get(v, 0) * LOW + F.get(v, 1)).cast("int"))
        late_date = let(F.get(v, 0) * LATE_LOW + F.get(v, 1), _late_date)
        styled = F.when(_day_first(m), F.date_format(late_date, "dd/MM/yyyy")).otherwise(_styled(m, date))
        number = lambda k, width: F.lpad(k.cast("string"), width, "0")
        bban = _to_chars(own_bban, v)
        iban = let(bban, lambda b: F.concat(m.substr(1, 2), number(98 - mod97(F.concat(b, m.substr(1, 2), F.lit("00"))), 2), b))
        card = let(F.concat(F.substring(digits, 1, 1), _to_chars(inner, v)), lambda d: F.concat(d, F.pmod(-luhn_sum(F.concat(d, F.lit("0"))), F.lit(10)).cast("string")))
        phone = F.concat(F.substring(digits, F.lit(1), n - 10), F.array_join(F.transform(v, lambda x, i: (x + offset(i)).cast("string")), ""))
        return (
            F.when(kind == "email", F.concat(_to_chars(local, v), host))
            .when(kind == "ip", F.array_join(v.cast("array<string>"), "."))
            .when(kind == "ip6", _to_chars(m, v))
            .when(kind == "phone", let(phone, lambda d: _overlaid(m, d)))
            .when(kind == "date", styled)
            .when(kind == "ssn", F.concat_ws("-", number(F.get(v, 0) + F.when(F.get(v, 0) >= 665, 2).otherwise(1), 3), number(F.get(v, 1) + 1, 2), number(F.get(v, 2) + 1, 4)))
            .when(kind == "iban", F.when(m.contains(" "), F.regexp_replace(iban, "(.{4})(?!$)", "$1 ")).otherwise(iban))
            .otherwise(let(card, lambda d: _overlaid(m, d)))
        )

    tweak = F.when(kind == "email", F.concat(kind, F.lower(host))).when((kind == "date") & _day_first(m), F.lit("late")).otherwise(kind)
    return F.when(kind.isNull(), m).otherwise(let(feistel(vector, key, tweak, back), written_as))


def _styled(m: Column, date: Column) -> Column:
    return F.when(m.substr(5, 1) == "-", F.date_format(date, "yyyy-MM-dd")).when(m.substr(3, 1) == ".", F.date_format(date, "dd.MM.yyyy")).otherwise(F.date_format(date, "MM/dd/yyyy"))


def _overlaid(m: Column, digits: Column) -> Column:
    """The match with its digits replaced in turn, other signs kept."""
    nth = lambda i: F.length(_digits(F.substring(m, F.lit(1), i + 1)))
    return F.array_join(F.transform(_chars(m), lambda c, i: F.when(c.between("0", "9"), F.substring(digits, nth(i), F.lit(1))).otherwise(c)), "")


def pseudonymise(docs: DataFrame, keep: list[str], key: str, text_col: str = "text", back: bool = False) -> DataFrame:
    """_kept (the ``keep`` columns, whatever their names), text with pseudonyms, and found (kind, value's pseudonym in order).

    A null text stays null and an empty one empty, both with nothing found; matches that fail
    their check stay as they are; null or repeated keys are rows as any other; an empty table
    gives no rows. ``back`` with the same key restores the texts. One pass, no shuffle.
    """
    text = F.col("_text")
    rows = docs.select(F.struct(*keep).alias("_kept"), F.col(text_col).alias("_text"))
    secret = F.lit(key)
    one = lambda m: let(kind_of(m), lambda kind: F.struct(kind.alias("kind"), pseudonym(m, kind, secret, back).alias("value")))
    none = F.array().cast("array<struct<kind:string,value:string>>")
    found = F.when(text.rlike(HINT), F.transform(F.regexp_extract_all(text, F.lit(f"({ANY})"), F.lit(0)), one)).otherwise(none)
    rows = rows.select("_kept", "_text", let(found, lambda f: F.struct(f.alias("f"), F.when(F.size(f) > 0, F.array_join(F.flatten(F.zip_with(F.split(text, ANY, -1), F.transform(f, lambda x: x["value"]), lambda a, b: F.array(a, F.coalesce(b, F.lit(""))))), "")).otherwise(text).alias("t"))).alias("_out"))
    return rows.select("_kept", F.col("_out.t").alias("text"), F.filter(F.coalesce(F.col("_out.f"), none), lambda x: x["kind"].isNotNull()).alias("found"))
