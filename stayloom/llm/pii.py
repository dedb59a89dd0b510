"""Format-preserving pseudonyms for personal numbers and dates, in DataFrame functions alone.

Candidates are found by pattern and then validated: payment cards by the Luhn sum, IBANs by their remainder, addresses
by the range of their parts, dates by the calendar, social security numbers by their forbidden blocks. What is valid is
replaced by a keyed permutation of the values of its format, so that the same value has the same pseudonym in every
document, different values have different ones, and the pseudonym is valid again:

* card: all digits but the last are permuted, the last makes the Luhn sum right;
* IBAN: the digits of the account part are permuted, country and letters stay, the check digits are made anew;
* phone: the national number is permuted among those of its length; a country code (found by the lengths that the
  numbering plan gives them) and zeros before the national number stay. So the national and the international notation
  of a number share their pseudonym in every country, and its first digit does not become a zero. National notations
  that are found: ten digits as 3-3-4, a zero and an area code before the number, five pairs, nine digits as 2-3-4.
  Digits without separators are no candidates, and other trunk prefixes than zero are not split off;
* social security number: the nine digits are permuted and permuted again until no block is forbidden;
* IPv4: the 32 bits are permuted;
* date (1900-01-01 to 2099-12-31): the day number is permuted within the two centuries.

The span is chosen after validation. A candidate for a card is a whole chain of digit groups, and its stretches on group
borders are tested as well: 13 to 19 digits that pass Luhn and either begin like a card of their length or come in
groups of three or more (the last may be shorter); where valid stretches overlap, the likelier form wins. A candidate
for an IBAN ends where the length of its country says; one that is not valid is searched for shorter ones and for cards.

Separators, brackets and signs stay where they are. E-mail addresses have no format to keep: the local part becomes a
keyed digest at ``mail.invalid``.

The permutation is a Feistel network of ROUNDS rounds over two residues whose product is the size of the format (a digit
string is cut in two halves; 73,049 days are 17 times 4,297), with SHA-256 over key, format, round and residue as the
round function. It needs no table and no shuffle: each text is rewritten where it is read.

The key is an argument. Take it from a secret store; DEMO_KEY is for tests and the registered query only.

Defined results: a null text stays null, an empty text empty. A text without candidates is returned as it is. Rows that
repeat an id are rewritten one by one. Other columns of the input are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ROUNDS = 10
DEMO_KEY = "stayloom-demo-key"

#: Countries by the length of their IBAN.
IBAN_LENGTHS = {
    15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH HR LI LV",
    22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL",
    24: "AD CZ ES MD PK RO SA SE SK TN VG YE", 25: "LY PT ST", 26: "IS TR", 27: "BI DJ FR GR IT MC MR SM",
    28: "AL AZ BY CY DO GT HN HU LB NI PL SV", 29: "BR EG PS QA UA", 30: "JO KW MU", 31: "MT SC", 32: "LC", 33: "RU"}
_GENERIC_IBAN = r"[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?"
_SIZED_IBAN = "|".join(
    "(?:%s)[0-9]{2}(?: ?[A-Z0-9]{4}){%d}%s" % (
        c.replace(" ", "|"), n // 4 - 1, " ?[A-Z0-9]{%d}" % (n % 4) if n % 4 else "") for n, c in IBAN_LENGTHS.items())
_IBAN_COUNTRY = "^(?:%s)" % "|".join(" ".join(IBAN_LENGTHS.values()).split())

#: Four groups of four that end a chain of digit groups; a phone number stops before them.
_FOUR_FOURS = r"[0-9]{4}(?:[ -][0-9]{4}){3}(?![ -]?[0-9])"

#: Patterns by kind, most specific first. The order is that of the alternatives.
PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]{1,64}@[A-Za-z0-9-]{1,63}(?:\.[A-Za-z0-9-]{1,63}){1,8}",
    "iban": r"(?<![A-Za-z0-9])(?:" + _SIZED_IBAN + "|" + _GENERIC_IBAN + r")(?![A-Za-z0-9])",
    "ipv4": r"(?<![0-9.])[0-9]{1,3}(?:\.[0-9]{1,3}){3}(?![0-9]|\.[0-9])",
    "date": (r"(?<![0-9./-])(?:(?:19|20)[0-9]{2}-[0-9]{2}-[0-9]{2}|(?:19|20)[0-9]{2}/[0-9]{2}/[0-9]{2}|[0-9]{2}/[0-9]{2}/(?:19|20)[0-9]{2}"
             r"|[0-9]{2}\.[0-9]{2}\.(?:19|20)[0-9]{2})(?![0-9]|[./-][0-9])"),
    "ssn": r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9]|-[0-9])",
    "card": "",
    "phone": (r"(?<![0-9A-Za-z+])(?:\+[0-9]{1,3}[ .-]?(?:\([0-9]{1,4}\)[ .-]?)?[0-9]{1,4}"
              r"(?:(?:[ .-](?!" + _FOUR_FOURS + r"))?[0-9]{2,4}){1,5}"
              r"|\([0-9]{3}\) ?[0-9]{3}[ .-][0-9]{4}|[0-9]{3}[.-][0-9]{3}[.-][0-9]{4}(?!-[0-9]))(?![0-9])"),
    "national": (r"(?<![0-9A-Za-z+(])(?<![0-9][ ./-])(?:0[1-9](?:[ .-][0-9]{2}){4}"
                 r"|(?:\(0[1-9][0-9]{0,3}\) ?|0[1-9][0-9]{0,3}[ /-])[0-9]{3,4}(?:[ -]?[0-9]{2,4}){1,2}"
                 r"|[2-9][0-9][ -][0-9]{3}[ -][0-9]{4})(?![0-9]|[./-][0-9])"),
}
#: Country codes of one and two digits in the international numbering plan; all others have three. Fixed values.
_COUNTRY_CODE = r"(?:1|7|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58]|[0-9]{3})"
# A chain of digit groups ends before a group that begins something else. Possessive: no stack for long chains.
_ELSE = "|".join(PATTERNS[k] for k in ("email", "ipv4", "date", "ssn", "phone"))
PATTERNS["card"] = r"(?<![0-9])(?!%s)[0-9](?:(?:[ -](?!%s))?[0-9]){12,}+" % (PATTERNS["phone"], _ELSE)
_ANY = "|".join(PATTERNS.values())
#: Beginnings and lengths of payment cards.
_ISSUED = (r"^(?:4(?:[0-9]{12}|[0-9]{15}|[0-9]{18})|(?:5[1-5]|2[2-7])[0-9]{14}|3[47][0-9]{13}|3[0689][0-9]{12}|35[0-9]{14}"
           r"|(?:5[06-8]|6[0-9])[0-9]{11,17})$")
_LIKELY_LENGTHS = (16, 15, 14, 19, 13, 18, 17)
_PIECE = "array<struct<text:string,kind:string>>"
_DAYS, _FIRST_DAY = (17, 4297), "1900-01-01"


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _round_value(key: str, kind: Column | str, step: Column, residue: Column) -> Column:
    kind = F.lit(kind) if isinstance(kind, str) else kind
    hexed = F.sha2(F.concat_ws("|", F.lit(key), kind, step.cast("string"), residue.cast("string")).cast("binary"), 256)
    return F.conv(F.substring(hexed, 1, 15), 16, 10).cast("long")  # 60 bits


def feistel(value: Column, left: Column, right: Column, key: str, kind: Column | str, back: bool = False) -> Column:
    """Permute 0 .. left * right - 1. Even rounds change the left residue, odd ones the right one."""
    def once(pair, step):
        even = step % 2 == 0
        size = F.when(even, left).otherwise(right)
        changed, other = F.when(even, pair["l"]).otherwise(pair["r"]), F.when(even, pair["r"]).otherwise(pair["l"])
        move = F.pmod(_round_value(key, kind, step, other), size)
        new = F.pmod(changed - move if back else changed + move, size)
        return F.struct(F.when(even, new).otherwise(pair["l"]).alias("l"),
                        F.when(even, pair["r"]).otherwise(new).alias("r"))

    steps = F.sequence(F.lit(ROUNDS - 1), F.lit(0), F.lit(-1)) if back else F.sequence(F.lit(0), F.lit(ROUNDS - 1))
    begin = F.struct(F.floor(value / right).cast("long").alias("l"), F.pmod(value, right).alias("r"))
    return F.aggregate(steps, begin, once, lambda pair: pair["l"] * right + pair["r"])


def _power(n: Column) -> Column:
    """10 ** n as a whole number."""
    return F.rpad(F.lit("1"), n + 1, "0").cast("long")


def permuted_digits(digits: Column, key: str, kind: str) -> Column:
    """Permute a string of 2 to 36 digits among the strings of its length, as two numbers that fit a long."""
    n = F.length(digits)
    half = F.floor(n / 2).cast("int")

    def once(pair, step):
        even = step % 2 == 0
        size = _power(F.when(even, half).otherwise(n - half))
        changed, other = F.when(even, pair["l"]).otherwise(pair["r"]), F.when(even, pair["r"]).otherwise(pair["l"])
        new = F.pmod(changed + F.pmod(_round_value(key, F.concat(F.lit(kind), n.cast("string")), step, other), size),
                     size)
        return F.struct(F.when(even, new).otherwise(pair["l"]).alias("l"),
                        F.when(even, pair["r"]).otherwise(new).alias("r"))

    begin = F.struct(F.substring(digits, F.lit(1), half).cast("long").alias("l"),
                     F.substring(digits, half + 1, n).cast("long").alias("r"))
    return F.aggregate(
        F.sequence(F.lit(0), F.lit(ROUNDS - 1)), begin, once,
        lambda pair: F.concat(F.lpad(pair["l"].cast("string"), half, "0"), F.lpad(pair["r"].cast("string"), n - half, "0")))


def _luhn(digits: Column) -> Column:
    """Luhn sum of a digit string whose last digit counts once."""
    n = F.length(digits)
    def term(i):
        d = F.substring(digits, i, F.lit(1)).cast("int")
        doubled = d * 2
        return F.when((n - i) % 2 == 0, d).otherwise(F.when(doubled > 9, doubled - 9).otherwise(doubled))
    return F.aggregate(F.sequence(F.lit(1), n), F.lit(0), lambda a, i: a + term(i))


def _remainder_97(text: Column) -> Column:
    """Remainder by 97 of an account number in which a letter stands for two digits."""
    def step(a, c):
        letter = c.rlike("[A-Z]")
        number = F.when(letter, F.ascii(c) - 55).otherwise(F.ascii(c) - 48)
        return F.pmod(a * F.when(letter, 100).otherwise(10) + number, F.lit(97))
    return F.aggregate(F.split(text, ""), F.lit(0), lambda a, c: F.when(c == "", a).otherwise(step(a, c)))


def _refill(shape: Column, digits: Column) -> Column:
    """Put digits into the digit places of ``shape``, in order."""
    marks = F.split(shape, "")
    filled = F.aggregate(
        marks, F.struct(F.lit("").alias("text"), F.lit(1).alias("at")),
        lambda a, c: F.when(c.rlike("[0-9]"), F.struct(
            F.concat(a["text"], F.substring(digits, a["at"], F.lit(1))).alias("text"), (a["at"] + 1).alias("at")))
        .otherwise(F.struct(F.concat(a["text"], c).alias("text"), a["at"].alias("at"))),
        lambda a: a["text"])
    return filled


def _octets(value: Column) -> Column:
    return F.transform(F.split(value, r"\."), lambda x: x.cast("long"))


def _day(value: Column) -> Column:
    """A date in one of the notations, or null."""
    return F.coalesce(F.try_to_date(value, "yyyy-MM-dd"), F.try_to_date(value, "yyyy/MM/dd"),
                      F.try_to_date(value, "dd/MM/yyyy"),
                      F.try_to_date(value, "MM/dd/yyyy"), F.try_to_date(value, "dd.MM.yyyy"))


def kind_of(value: Column) -> Column:
    """The kind of a candidate that is valid, or null."""
    digits, n = _digits(value), F.length(_digits(value))
    flat = F.replace(value, F.lit(" "), F.lit(""))
    octets = _octets(value)
    whole = {k: value.rlike(f"^(?:{p})\\z") for k, p in PATTERNS.items()}
    return (
        F.when(whole["email"], "email")
        .when(whole["iban"], F.when(_valid_iban(value), "iban"))
        .when(whole["ipv4"], F.when(F.forall(octets, lambda x: x <= 255), "ipv4"))
        .when(whole["date"], F.when(_day(value).isNotNull(), "date"))
        .when(whole["ssn"], F.when(_allowed_ssn(digits), "ssn"))
        .when(whole["card"] & n.between(13, 19) & (_luhn(digits) % 10 == 0), "card")
        .when(whole["phone"] & n.between(8, 15), "phone")
        .when(whole["national"] & n.between(9, 12), "phone"))


def _valid_iban(value: Column) -> Column:
    flat = F.replace(value, F.lit(" "), F.lit(""))
    return (F.length(flat).between(15, 34) & (value.rlike(f"^(?:{_SIZED_IBAN})\\z") | ~value.rlike(_IBAN_COUNTRY))
            & (_remainder_97(F.concat(F.substring(flat, F.lit(5), F.lit(40)), F.substring(flat, 1, 4))) == 1))


def _let(value: Column, use) -> Column:
    """``use(value)`` with the value found once."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _stretch(value: Column, start: Column, end: Column, whole: Column) -> Column:
    """``rank, start, end, kind`` of a stretch (places from 1, end excluded) that is a card or an IBAN, or null."""
    def judged(text):
        def card(digits):
            n = F.length(digits)
            grouped = text.rlike(r"^[0-9]{3,}(?:[ -][0-9]{3,})*(?:[ -][0-9]+)?$")
            form = F.when(digits.rlike(_ISSUED), F.when(grouped, 1).otherwise(2)).when(grouped, 3).when(whole, 4)
            place = F.array_position(F.array(*(F.lit(k) for k in _LIKELY_LENGTHS)), n)
            return F.when(n.between(13, 19), F.when(form.isNotNull(), F.when(_luhn(digits) % 10 == 0, F.struct(
                (form * 10 + place).cast("int").alias("rank"), start.alias("start"), end.alias("end"),
                F.lit("card").alias("kind")))))

        return F.when(text.rlike(r"^[0-9][0-9 -]+$"), _let(_digits(text), card)).when(
            text.rlike(f"^(?:{_SIZED_IBAN}|{_GENERIC_IBAN})\\z"), F.when(_valid_iban(text), F.struct(
                F.lit(0).alias("rank"), start.alias("start"), end.alias("end"), F.lit("iban").alias("kind"))))

    # 34 characters and their blanks are the longest; longer stretches are not cut out
    return F.when((end - start).between(13, 46), _let(F.substring(value, start, end - start), judged))


def _stretches(value: Column) -> Column:
    """All valid cards and IBANs on group borders of a chain, as :func:`_stretch` gives them."""
    def of(groups):
        starts = F.aggregate(groups, F.array(F.lit(1)), lambda a, g: F.concat(
            a, F.array(F.element_at(a, -1) + F.length(g) + 1)))
        size = F.size(groups)
        return _let(starts, lambda at: F.flatten(F.transform(
            F.sequence(F.lit(0), size - 1), lambda i: F.array_compact(F.transform(
                F.sequence(i, F.least(i + 18, size - 1)), lambda j: _stretch(
                    value, F.get(at, i), F.get(at, j + 1) - 1, (i == 0) & (j == size - 1)))))))
    return _let(F.split(value, "[ -]"), of)


def _cut(value: Column) -> Column:
    """A chain as pieces ``text, kind``: the likeliest valid stretches that do not overlap, and what is between them."""
    def pieces(chosen):
        done = F.aggregate(
            chosen, F.struct(F.lit(1).alias("at"), F.array().cast(_PIECE).alias("pieces")),
            lambda a, s: F.struct(s["end"].alias("at"), F.concat(a["pieces"], F.array(
                F.struct(F.substring(value, a["at"], s["start"] - a["at"]).alias("text"),
                         F.lit(None).cast("string").alias("kind")),
                F.struct(F.substring(value, s["start"], s["end"] - s["start"]).alias("text"),
                         s["kind"].alias("kind")))).alias("pieces")),
            lambda a: F.concat(a["pieces"], F.array(F.struct(
                F.substring(value, a["at"], F.length(value)).alias("text"), F.lit(None).cast("string").alias("kind")))))
        return done

    def choose(valid):
        return F.aggregate(F.array_sort(valid), F.slice(valid, 1, 0), lambda a, s: F.when(
            F.exists(a, lambda t: (t["start"] < s["end"]) & (s["start"] < t["end"])), a).otherwise(
            F.concat(a, F.array(s))))

    by_place = lambda s, t: F.when(s["start"] < t["start"], -1).otherwise(1)
    return _let(_stretches(value), lambda valid: _let(F.array_sort(choose(valid), by_place), pieces))


def pieces_of(value: Column) -> Column:
    """A candidate as pieces ``text, kind``; kind is null where a piece stays as it is."""
    def of(kind):
        chain = F.coalesce(kind == "card", F.lit(True)) & value.rlike(r"^[A-Z0-9][A-Z0-9 -]{12,}$") & value.rlike("[ -]")
        return F.when(chain, _cut(value)).otherwise(F.array(F.struct(value.alias("text"), kind.alias("kind"))))
    return _let(kind_of(value), of)


def _allowed_ssn(digits: Column) -> Column:
    return ~(digits.rlike(r"^(?:000|666|9)") | (F.substring(digits, 4, 2) == "00") | (F.substring(digits, 6, 4) == "0000"))


def _card(value: Column, key: str) -> Column:
    digits = _digits(value)
    body = permuted_digits(F.substring(digits, F.lit(1), F.length(digits) - 1), key, "card")
    return _refill(value, F.concat(body, F.pmod(F.lit(10) - _luhn(F.concat(body, F.lit("0"))) % 10, F.lit(10))
                                   .cast("string")))


def _phone(value: Column, key: str) -> Column:
    digits = _digits(value)
    before = F.when(value.startswith("+"), F.regexp_extract(digits, f"^{_COUNTRY_CODE}0*", 0)).otherwise(
        F.regexp_extract(digits, "^0*", 0))
    number = F.substring(digits, F.length(before) + 1, F.length(digits))

    def step(x):
        return permuted_digits(x, key, "phone")
    # walk the cycle past numbers that begin with a zero
    walked = F.aggregate(F.sequence(F.lit(1), F.lit(40)), step(number),
                         lambda x, _: F.when(~x.startswith("0"), x).otherwise(step(x)))
    return F.when(F.length(number) < 2, value).otherwise(_refill(value, F.concat(before, walked)))


def _ssn(value: Column, key: str) -> Column:
    """Walk the cycle: from an allowed number the permutation comes back to an allowed one, at the latest to itself."""
    def step(x):
        return permuted_digits(x, key, "ssn")
    walked = F.aggregate(
        F.sequence(F.lit(1), F.lit(40)), step(_digits(value)),
        lambda x, _: F.when(_allowed_ssn(x), x).otherwise(step(x)))
    return _refill(value, walked)


def _ipv4(value: Column, key: str) -> Column:
    o, half = _octets(value), F.lit(65536).cast("long")
    new = feistel(((o[0] * 256 + o[1]) * 256 + o[2]) * 256 + o[3], half, half, key, "ipv4")
    return F.concat_ws(".", *(F.pmod(F.shiftright(new, s), F.lit(256)).cast("string") for s in (24, 16, 8, 0)))


def _date(value: Column, key: str) -> Column:
    first = F.lit(_FIRST_DAY).cast("date")
    left, right = (F.lit(x).cast("long") for x in _DAYS)
    new = F.date_add(first, feistel(F.datediff(_day(value), first).cast("long"), left, right, key, "date").cast("int"))
    month_first = F.try_to_date(value, "dd/MM/yyyy").isNull()
    return (F.when(value.contains("-"), F.date_format(new, "yyyy-MM-dd"))
            .when(value.contains("."), F.date_format(new, "dd.MM.yyyy"))
            .when(value.rlike("^[0-9]{4}/"), F.date_format(new, "yyyy/MM/dd")).when(month_first, F.date_format(new, "MM/dd/yyyy")).otherwise(F.date_format(new, "dd/MM/yyyy")))


def _iban(value: Column, key: str) -> Column:
    flat = F.replace(value, F.lit(" "), F.lit(""))
    account = F.substring(flat, F.lit(5), F.lit(40))
    digits = _digits(account)
    fresh = F.when(F.length(digits) >= 2, _refill(account, permuted_digits(digits, key, "iban"))).otherwise(account)
    country = F.substring(flat, 1, 2)
    check = F.lpad((F.lit(98) - _remainder_97(F.concat(fresh, country, F.lit("00")))).cast("string"), 2, "0")
    plain = F.concat(country, check, fresh)
    spaced = F.rtrim(F.regexp_replace(plain, "(.{4})", "$1 "))
    return F.when(value.contains(" "), spaced).otherwise(plain)


def _email(value: Column, key: str) -> Column:
    name = F.substring(F.sha2(F.concat_ws("|", F.lit(key), F.lit("email"), F.lower(value)).cast("binary"), 256), 1, 16)
    return F.concat(F.lit("u"), name, F.lit("@mail.invalid"))


def pseudonym(value: Column, kind: Column, key: str) -> Column:
    """The pseudonym of a valid value of a kind; anything else stays."""
    return (F.when(kind == "email", _email(value, key)).when(kind == "iban", _iban(value, key))
            .when(kind == "ipv4", _ipv4(value, key)).when(kind == "date", _date(value, key))
            .when(kind == "ssn", _ssn(value, key)).when(kind == "card", _card(value, key))
            .when(kind == "phone", _phone(value, key)).otherwise(value))


def pseudonymised(docs: DataFrame, key: str, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``doc_id, text, n_replaced, kinds``: texts with pseudonyms and the kinds of what was replaced, in order."""
    text = F.col(text_column)
    cut = docs.select(F.col(id_column).cast("long").alias("doc_id"), text.alias("text"),
                      F.when(text.rlike(r"[0-9@]"), F.regexp_extract_all(text, F.lit(_ANY), 0)).alias("found"))
    known = cut.withColumn("pieces", F.transform("found", pieces_of)).withColumn(
        "kinds", F.transform(F.flatten("pieces"), lambda p: p["kind"]))
    parts = known.withColumn("between", F.when(
        F.exists("kinds", lambda k: k.isNotNull()), F.split("text", _ANY, -1)))
    fresh = parts.withColumn("fresh", F.when(F.col("between").isNotNull(), F.transform(
        "pieces", lambda found: F.array_join(F.transform(found, lambda p: pseudonym(p["text"], p["kind"], key)), ""))))
    rewritten = F.array_join(F.zip_with("between", F.concat("fresh", F.array(F.lit(""))),
                                        lambda b, f: F.concat(b, F.coalesce(f, F.lit("")))), "")
    kinds = F.coalesce(F.array_compact("kinds"), F.array().cast("array<string>"))
    return fresh.select("doc_id", F.when(F.col("between").isNotNull(), rewritten).otherwise(F.col("text")).alias("text"),
                        F.size(kinds).cast("long").alias("n_replaced"), kinds.alias("kinds"))
