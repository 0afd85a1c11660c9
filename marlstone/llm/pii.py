"""Personal values replaced by pseudonyms of the same format. DataFrame
functions only.

Numbers and dates that pass their format's own validation are permuted by a
keyed Feistel network on the two halves of what may vary, so the pseudonym is
valid in the same format, different values keep different pseudonyms, equal
values get equal ones in all documents, and the key's owner can undo it
(``restore``):

- payment cards (13 to 19 digits, Luhn): all but the first digit and the check
  digit, which is computed anew;
- North American telephone numbers (after +1 with any area code): eight of ten
  digits; other numbers with + and country code, 8 to 15 digits in any groups:
  the digits after the first two;
- IPv4 addresses (octets up to 255): the last three octets;
- social security numbers (valid areas, groups and serials): group and serial;
- IBANs (modulo 97): the last run of digits, or all digits of one that does not
  end in two, check digits computed anew;
- dates (calendar dates as 2024-02-29, 29.02.2024, 02/29/2024): the day within
  its stretch of 72,900 days, about 1900 to 2099 for the present one.

E-mail addresses and secrets (values of password, token and the like) have no
validated numeric form; they get keyed hashes of their own shape, equal where
they are equal, and ``restore`` leaves those.

A value is found by one pattern whose parts are bounded or possessive, so long
texts take time in proportion. What a pattern finds and validation rejects stays as it is.

Defined cases: NULL text stays NULL, a text without values is unchanged;
repeated rows give equal results; other columns, doc_id and NULLs in them
included, stay as they are; columns called like the two new ones are replaced;
an empty table gives an empty one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ROUNDS = 10
#: Days of a stretch of dates: 270 * 270.
DAY_SIDE = 270

EMAIL = (r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}+@[A-Za-z0-9-]{1,63}(?:\.[A-Za-z0-9-]{1,63}){1,8}")
SECRET = (r"(?<![A-Za-z0-9])(?i:password|passwd|pwd|secret|token|api[_-]?key|access[_-]?key)"
          r"[\"']?\s{0,3}[:=]\s{0,3}[\"']?[^\s\"']{6,}+")
#: Characters of an IBAN by country.
IBAN_SIZES = {
    15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH HR LI LV",
    22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG",
    25: "LY PT ST", 26: "IS TR", 27: "BI DJ FR GR IT MC MR SM", 28: "AL AZ BY CY DO EG GT HU LB NI PL SV",
    29: "BR PS QA UA", 30: "JO KW MU YE", 31: "MT SC", 32: "LC", 33: "RU"}
_IBAN_OF = "|".join(
    "(?:" + countries.replace(" ", "|") + ")[0-9]{2}(?: ?[A-Z0-9]{4}){" + str((size - 4) // 4) + "}"
    + (" ?[A-Z0-9]{" + str(size % 4) + "}" if size % 4 else "") + "(?![A-Za-z0-9])"
    for size, countries in IBAN_SIZES.items())
#: The country's length first; then any, for other countries.
IBAN = (r"(?<![A-Za-z0-9])(?=[A-Z]{2}[0-9]{2})(?:" + _IBAN_OF
        + r"|[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9]))")
NANP = (r"(?<![0-9+])(?:\+1[ .-]?(?:\([0-9]{3}\) ?|[0-9]{3}[ .-]?)[0-9]{3}[ .-]?[0-9]{4}"
        r"|(?:\([2-9][0-9]{2}\) ?|[2-9][0-9]{2}[ .-])[2-9][0-9]{2}[ .-][0-9]{4})(?![0-9])")
ABROAD = r"\+[2-9](?:[ .()-]{0,2}[0-9]){7,14}(?![0-9])"
CARD = (r"(?<![0-9.])(?:[0-9]{13,19}|[0-9]{4}(?:[ ][0-9]{4}){3}|[0-9]{4}(?:-[0-9]{4}){3}"
        r"|[0-9]{4}[ -][0-9]{6}[ -][0-9]{5})(?![0-9])")
IPV4 = r"(?<![0-9.])(?:[0-9]{1,3}\.){3}[0-9]{1,3}(?![0-9]|\.[0-9])"
SSN = r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])"
DATE = (r"(?<![0-9./-])(?:[0-9]{4}-[0-9]{2}-[0-9]{2}|[0-9]{2}\.[0-9]{2}\.[0-9]{4}|[0-9]{2}/[0-9]{2}/[0-9]{4})"
        r"(?![0-9]|[./-][0-9])")
#: The patterns above in their order, each only where its first character can stand: most
#: places, inside a word, take two looks instead of one for each pattern.
ANY = ("(?=[A-Za-z])(?<![A-Za-z0-9])(?:" + "|".join([EMAIL, "(?=[apstAPST])" + SECRET, IBAN]) + ")|(?=[0-9+(._%-])(?:"
       + "|".join([EMAIL, NANP, ABROAD, CARD, IPV4, SSN, DATE]) + ")")


#: Kinds whose varying part is a string of digits.
DIGITS = ("card", "phone", "abroad", "iban")


def _long(c: Column) -> Column:
    return c.cast("long")


def _at(text: Column, start, length) -> Column:
    one = lambda x: x if isinstance(x, Column) else F.lit(x)
    return text.substr(one(start).cast("int"), one(length).cast("int"))


def _noise(key: str, kind: Column, turn: Column, size: Column, half: Column) -> Column:
    """A number below 2^60 that depends on the key and one half."""
    seed = F.concat_ws("|", F.lit(key), kind, turn.cast("string"), size.cast("string"), half.cast("string"))
    return _long(F.conv(F.substring(F.sha2(seed, 256), 1, 15), 16, 10))


def feistel(m: Column, key: str, restore: bool) -> Column:
    """Struct a, b: the halves a and b of ``m`` permuted together, each below
    its side."""
    sign = -1 if restore else 1

    def turn(state: Column, i: Column) -> Column:
        a, b = state["a"], state["b"]
        even = i % 2 == 0
        side, other = F.when(even, m["side_a"]).otherwise(m["side_b"]), F.when(even, b).otherwise(a)
        mine = F.when(even, a).otherwise(b)
        new = F.pmod(mine + sign * F.pmod(_noise(key, m["kind"], i, side, other), side), side)
        return F.struct(F.when(even, new).otherwise(a).alias("a"), F.when(even, b).otherwise(new).alias("b"))
    turns = F.array(*[F.lit(i) for i in (reversed(range(ROUNDS)) if restore else range(ROUNDS))])
    return F.aggregate(turns, F.struct(m["a"].alias("a"), m["b"].alias("b")), turn)


def _luhn_sum(digits: Column, doubled: int) -> Column:
    """Luhn sum; positions from the right with this parity count double."""
    n = F.length(digits)

    def add(s: Column, i: Column) -> Column:
        digit = _at(digits, i, 1).cast("int")
        twice = digit * 2 - F.when(digit > 4, 9).otherwise(0)
        return s + F.when((n - i) % 2 == doubled, twice).otherwise(digit)
    return F.when(n > 0, F.aggregate(F.sequence(F.lit(1), F.greatest(n, F.lit(1))), F.lit(0), add)).otherwise(0)


def _mod97(plain: Column) -> Column:
    """An IBAN's characters, the first four last, as a number modulo 97."""
    turned = F.concat(_at(plain, 5, 64), _at(plain, 1, 4))
    return F.aggregate(F.split(turned, ""), F.lit(0), lambda s, c: F.when(c == "", s).when(
        c <= "9", (s * 10 + F.ascii(c) - 48) % 97).otherwise((s * 100 + F.ascii(c) - 55) % 97))


def _filled(shape: Column, chars: Column, keep: str) -> Column:
    """``shape`` with its characters but those of the pattern ``keep``
    replaced by ``chars`` in turn."""
    start = F.struct(F.lit("").alias("out"), F.lit(1).alias("at"))

    def put(s: Column, c: Column) -> Column:
        kept = c.rlike(keep)
        return F.struct(F.concat(s["out"], F.when(kept, c).otherwise(_at(chars, s["at"], 1))).alias("out"),
                        (s["at"] + F.when(kept, 0).otherwise(1)).alias("at"))
    return F.aggregate(F.split(shape, ""), start, put)["out"]


def _keep(m: Column, fields: list[str], **more: Column) -> Column:
    return F.struct(*[m[f].alias(f) for f in fields], *[c.alias(n) for n, c in more.items()])


def _ends_in_digits(m: Column) -> Column:
    return _at(m["plain"], 5, 64).rlike("[0-9]{2}$")


def _free(m: Column) -> Column:
    """The digits that vary, of kinds with a string of them."""
    d = m["digits"]
    n = F.length(d)
    return (F.when(m["kind"] == "card", _at(d, 2, n - 2))
            .when(m["kind"] == "phone", F.concat(_at(d, n - 8, 2), _at(d, n - 5, 6)))
            .when(m["kind"] == "abroad", _at(d, 3, n))
            .when((m["kind"] == "iban") & _ends_in_digits(m), F.regexp_extract(_at(m["plain"], 5, 64), "([0-9]{2,})$", 1))
            .when(m["kind"] == "iban", F.regexp_replace(_at(m["plain"], 5, 64), "[^0-9]", "")))


def _valid(m: Column) -> Column:
    old, kind, parts = m["old"], m["kind"], F.split(m["old"], "-")
    return (F.when(kind == "card", _luhn_sum(m["digits"], 1) % 10 == 0)
            .when(kind == "phone", F.lit(True))
            .when(kind == "abroad", F.length(m["digits"]).between(8, 15))
            .when(kind == "iban", (_mod97(m["plain"]) == 1) & _at(m["plain"], 5, 64).rlike("[0-9]"))
            .when(kind == "ipv4", F.forall(F.split(old, r"\."), lambda x: x.cast("int") <= 255))
            .when(kind == "ssn", ~parts[0].isin("000", "666") & (parts[0] < "900") & (parts[1] != "00")
                  & (parts[2] != "0000"))
            .when(kind == "date", m["day"].isNotNull() & F.year(m["day"]).between(1800, 2200))
            .otherwise(F.lit(False)))


def _day(old: Column) -> Column:
    iso = (F.when(old.contains("."), F.concat_ws("-", _at(old, 7, 4), _at(old, 4, 2), _at(old, 1, 2)))
           .when(old.contains("/"), F.concat_ws("-", _at(old, 7, 4), _at(old, 1, 2), _at(old, 4, 2))).otherwise(old))
    return F.try_to_date(iso, "yyyy-MM-dd")


def _halves(m: Column) -> dict[str, Column]:
    """a and b, side_a and side_b of a valid value; 0 and 1 of others."""
    kind, n, cut = m["kind"], F.length(m["free"]), F.floor(F.length(m["free"]) / 2)
    digits = kind.isin(*DIGITS)
    octet = lambda i: F.split(m["old"], r"\.")[i].cast("int")
    part = lambda i: F.split(m["old"], "-")[i].cast("int") - 1
    day = F.datediff(m["day"], F.lit("1900-01-01").cast("date"))
    side = F.lit(DAY_SIDE)
    choose = lambda text, ip, ssn, date, none: _long(F.when(~m["valid"], F.lit(none)).when(digits, text)
                                                    .when(kind == "ipv4", ip).when(kind == "ssn", ssn).otherwise(date))
    number = lambda c: F.when(c == "", F.lit("0")).otherwise(c).cast("long")
    return {
        "a": choose(number(_at(m["free"], 1, cut)), octet(1) * 16 + F.floor(octet(2) / 16), part(1),
                    F.floor(F.pmod(day, side * side) / side), 0),
        "b": choose(number(_at(m["free"], cut + 1, n)), (octet(2) % 16) * 256 + octet(3), part(2),
                    F.pmod(day, side) , 0),
        "side_a": choose(F.pow(F.lit(10.0), cut), F.lit(4096), F.lit(99), side, 1),
        "side_b": choose(F.pow(F.lit(10.0), n - cut), F.lit(4096), F.lit(9999), side, 1)}


def _permuted(m: Column) -> Column:
    """The varying digits after the permutation."""
    n = F.length(m["free"])
    cut = F.floor(n / 2).cast("int")
    pad = lambda c, k: F.lpad(c.cast("string"), k, "0")
    return F.when(m["valid"] & m["kind"].isin(*DIGITS),
                  F.concat(F.when(cut > 0, pad(m["f"]["a"], cut)).otherwise(""), pad(m["f"]["b"], (n - cut).cast("int"))))


def _body(m: Column) -> Column:
    """All digits of cards and phones, all characters of IBANs, with the check
    digit or digits yet to be set."""
    d, p, n = m["digits"], m["p"], F.length(m["digits"])
    return (F.when(m["kind"] == "card", F.concat(_at(d, 1, 1), p))
            .when(m["kind"] == "phone", F.concat(_at(d, 1, n - 9), _at(p, 1, 2), _at(d, n - 6, 1), _at(p, 3, 6)))
            .when(m["kind"] == "abroad", F.concat(_at(d, 1, 2), p))
            .when((m["kind"] == "iban") & ~_ends_in_digits(m), F.concat(
                _at(m["plain"], 1, 2), F.lit("00"), _filled(_at(m["plain"], 5, 64), p, "^[^0-9]?$")))
            .when(m["kind"] == "iban", F.concat(
                _at(m["plain"], 1, 2), F.lit("00"), _at(m["plain"], 5, F.length(m["plain"]) - F.length(p) - 4), p)))


def _whole(m: Column) -> Column:
    body = m["body"]
    check = F.pmod(-_luhn_sum(body, 0), F.lit(10)).cast("string")
    return (F.when(m["kind"] == "card", F.concat(body, check))
            .when(m["kind"] == "iban", F.concat(_at(body, 1, 2), F.lpad((98 - _mod97(body)).cast("string"), 2, "0"),
                                                _at(body, 5, 64)))
            .otherwise(body))


def _new(m: Column, key: str, restore: bool) -> Column:
    old, kind, f = m["old"], m["kind"], m["f"]
    number = f["a"] * 4096 + f["b"]
    ip = F.concat_ws(".", F.split(old, r"\.")[0], F.floor(number / 65536).cast("string"),
                     (F.floor(number / 256) % 256).cast("string"), (number % 256).cast("string"))
    ssn = F.concat_ws("-", _at(old, 1, 3), F.lpad((f["a"] + 1).cast("string"), 2, "0"),
                      F.lpad((f["b"] + 1).cast("string"), 4, "0"))
    first = F.lit("1900-01-01").cast("date")
    stretch = F.floor(F.datediff(m["day"], first) / (DAY_SIDE * DAY_SIDE)) * (DAY_SIDE * DAY_SIDE)
    day = F.date_add(first, (stretch + f["a"] * DAY_SIDE + f["b"]).cast("int"))
    date = (F.when(old.contains("."), F.date_format(day, "dd.MM.yyyy"))
            .when(old.contains("/"), F.date_format(day, "MM/dd/yyyy")).otherwise(F.date_format(day, "yyyy-MM-dd")))
    out = (F.when(m["valid"] & (kind == "iban"), _filled(old, m["whole"], "^ ?$"))
           .when(m["valid"] & kind.isin(*DIGITS), _filled(old, m["whole"], "^[^0-9]?$"))
           .when(m["valid"] & (kind == "ipv4"), ip).when(m["valid"] & (kind == "ssn"), ssn)
           .when(m["valid"] & (kind == "date"), date))
    if not restore:
        out = out.when(kind == "email", _email(old, key)).when(kind == "secret", _secret(old, key))
    return out.otherwise(old)


def _keyed_hash(key: str, kind: str, value: Column) -> Column:
    return F.sha2(F.concat_ws("|", F.lit(key), F.lit(kind), value), 256)


def _email(m: Column, key: str) -> Column:
    h = _keyed_hash(key, "email", F.lower(m))
    return F.concat(F.lit("u"), F.substring(h, 1, 16), F.lit("@d"), F.substring(h, 17, 8), F.lit(".invalid"))


def _secret(m: Column, key: str) -> Column:
    value = F.regexp_extract(m, r"[:=]\s{0,3}[\"']?([^\s\"']+)$", 1)
    name = _at(m, 1, F.length(m) - F.length(value))
    times = F.ceil(F.length(value) / 64).cast("int")
    return F.concat(name, _at(F.repeat(_keyed_hash(key, "secret", value), times), 1, F.length(value)))


def kind_of(m: Column) -> Column:
    whole = lambda p: m.rlike("^(?:" + p + ")$")
    return (F.when(whole(EMAIL), "email").when(whole(SECRET), "secret").when(whole(IBAN), "iban")
            .when(whole(NANP), "phone").when(whole(ABROAD), "abroad").when(whole(CARD), "card")
            .when(whole(IPV4), "ipv4").when(whole(SSN), "ssn").when(whole(DATE), "date"))


def pseudonyms(rows: DataFrame, key: str, restore: bool) -> DataFrame:
    """``rows`` whose _found, an array of values, becomes one of old, kind, new.
    One step after the other, so that no step repeats an earlier one's work."""
    def step(rows: DataFrame, make) -> DataFrame:
        return rows.withColumn("_found", F.transform("_found", make))

    base = ["old", "kind", "digits", "plain", "day"]
    rows = step(rows, lambda m: F.struct(m.alias("old"), kind_of(m).alias("kind")))
    rows = step(rows, lambda m: _keep(m, base[:2], digits=F.regexp_replace(m["old"], "[^0-9]", ""),
                                      plain=F.regexp_replace(m["old"], " ", ""),
                                      day=F.when(m["kind"] == "date", _day(m["old"]))))
    rows = step(rows, lambda m: _keep(m, base, free=F.coalesce(_free(m), F.lit("")), valid=F.coalesce(_valid(m), F.lit(False))))
    base += ["free", "valid"]
    rows = step(rows, lambda m: _keep(m, base, **_halves(m)))
    rows = step(rows, lambda m: _keep(m, base, f=feistel(m, key, restore)))
    base += ["f"]
    rows = step(rows, lambda m: _keep(m, base, p=_permuted(m)))
    rows = step(rows, lambda m: _keep(m, base, body=_body(m)))
    rows = step(rows, lambda m: _keep(m, base, whole=_whole(m)))
    return step(rows, lambda m: _keep(m, ["old", "kind"], new=_new(m, key, restore)))


def pseudonymise(docs: DataFrame, key: str, restore: bool = False) -> DataFrame:
    """``docs`` with pseudonyms in text, and n_values (values replaced) and
    kinds (their kinds, sorted, comma-joined)."""
    others = [c for c in docs.columns if c not in ("n_values", "kinds")]
    # one row's text is searched once, and cut only where something is found
    none = F.array().cast("array<string>")
    found = docs.select(F.struct(*[c for c in others if c != "text"]).alias("_row"), "text",
                        F.coalesce(F.regexp_extract_all("text", F.lit(ANY), 0), none).alias("_found"))
    found = found.withColumn("_parts", F.when(F.size("_found") > 0, F.split("text", ANY, -1)))
    hit = pseudonyms(found, key, restore)
    hit = hit.select("_row", "text", "_parts", "_found",
                     F.filter("_found", lambda m: ~m["new"].eqNullSafe(m["old"])).alias("_changed"))
    text = F.concat(F.array_join(F.zip_with(
        F.slice("_parts", 1, F.size("_found")), F.col("_found"), lambda p, m: F.concat(p, m["new"])), ""),
        F.element_at("_parts", -1))
    hit = hit.select("_row", F.when(F.size("_found") > 0, text).otherwise(F.col("text")).alias("text"),
                     F.size("_changed").cast("long").alias("n_values"),
                     F.array_join(F.sort_array(F.array_distinct(F.transform("_changed", lambda m: m["kind"]))), ",").alias("kinds"))
    return hit.select(
        *[F.col("text") if c == "text" else F.col("_row").getField(c).alias(c) for c in others], "n_values", "kinds")
