"""Format-preserving pseudonyms for personal data, in DataFrame expressions.

Candidates are found by one pattern, validated by kind (check digits, ranges, calendar), and permuted by a keyed
Feistel network over their own format: digits stay digits, letters stay letters of their case, cards and account
numbers keep valid check digits, addresses and dates stay valid.  The permutation depends on the key and the
kind only, so equal values get equal pseudonyms in all documents, however they are grouped by blanks or dashes.
What fails validation is left as it is.  Account and card numbers are looked for at every group of a run of groups,
so that an amount before or a code behind does not hide them; of two that overlap the surer one is taken.

The key is a parameter; whoever has it could undo the pseudonyms, so a production run passes its own secret.
Null texts stay null, empty ones empty; texts without a find are returned unchanged.  Repeated rows give
repeated results, and an empty table an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

KEY = "change-me"
ROUNDS = 8

# Kinds in the order in which they are tried at a place; patterns are fixed formats.  Each starts with what may
# not stand before it, so that most places are passed over at once.
BEFORE = r"(?<![\p{L}\p{N}_])"
AFTER = r"(?![\p{L}\p{N}_])"
EMAIL = r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++@(?:[A-Za-z0-9-]{1,63}\.){1,8}[A-Za-z]{2,24}" + AFTER
# What ends in 7 to 15 digits after a plus sign; looking back takes no repeated group.
PHONE_SIZE = r"(?<=\+" + "[0-9][ .()-]{0,3}" * 6 + "(?:[0-9][ .()-]{0,3})?" * 8 + "[0-9])"
FORMATS = {
    "ip": r"(?<![0-9]\.)[0-9]{1,3}(?:\.[0-9]{1,3}){3}(?!\.?[0-9])" + AFTER,
    "date": r"(?:(?:19|20)[0-9]{2}-[0-9]{2}-[0-9]{2}|(?:19|20)[0-9]{2}/[0-9]{2}/[0-9]{2}"
    + r"|[0-9]{2}[./-][0-9]{2}[./-](?:19|20)[0-9]{2})" + AFTER,
    "ssn": r"(?<!-)[0-9]{3}-[0-9]{2}-[0-9]{4}(?!-)" + AFTER,
    # With a plus sign as many groups as make 15 digits at most, none of them from a card behind it.
    "phone": r"(?<!\+)\+[0-9]{1,3}(?:[ .-]?\([0-9]{1,4}\))?"
    + r"(?:(?![ -]?(?:[0-9]{4}[ -]?){3}[0-9]{4}(?![0-9]|[ -]?[0-9]{4}(?![0-9/-])))[ .-]?[0-9]{1,4}){2,6}" + PHONE_SIZE + AFTER
    + r"|(?:\([0-9]{3}\) ?|[0-9]{3}[ .-])[0-9]{3}[ .-][0-9]{4}" + AFTER,
}
# Groups of digits (or capitals) that blanks or dashes join are taken as one run, up to where something else starts;
# the account and card numbers are chosen inside it (``parts_of``).
ELSE = "(?!" + "|".join(f"(?:{p})" for p in (EMAIL, *FORMATS.values())) + ")"
RUNS = {
    "iban": r"(?=[A-Z]{2}[0-9]{2}(?:(?: " + ELSE + r")?[A-Z0-9]){8}[A-Z0-9]*+" + AFTER + ")"
    + r"[A-Z0-9]++(?:[ -]" + ELSE + "[A-Z0-9]++" + AFTER + ")*+",
    "card": r"(?=[0-9](?:(?:[ -]" + ELSE + r")?[0-9]){12}[0-9]*+" + AFTER + ")"
    + r"[0-9]++(?:[ -]" + ELSE + "[0-9]++" + AFTER + ")*+",
}
NUMBERS = {"iban": RUNS["iban"], **FORMATS, "card": RUNS["card"]}
# Characters of an account number by country.
IBAN_LENGTHS = {
    15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH HR LI LV",
    22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG",
    25: "LY PT ST", 26: "IS TR", 27: "BI DJ FR GR IT MC MR SM", 28: "AL AZ BY CY DO GT HN HU LB NI PL SV",
    29: "BR EG PS QA UA", 30: "JO KW MU YE", 31: "MT SC", 32: "LC", 33: "RU",
}
# The usual groups of a card number.
CARD_GROUPS = "^(?:[0-9]{13,19}|[0-9]{4}(?:[ -][0-9]{4}){3}|[0-9]{4}[ -][0-9]{6}[ -][0-9]{4,5})$"
NUMBER = r"(?=[0-9+(A-Z])" + BEFORE + "(?:" + "|".join(f"(?:{p})" for p in NUMBERS.values()) + ")"
# Texts with an @ are searched for both, texts with a digit for numbers only, others not at all.
PATTERN = f"(?:{EMAIL})|{NUMBER}"

FIRST_DAY = "1900-01-01"
# Days of 1900 to 2099: 17 * 4297.
DAY_HALVES = (17, 4297)
IP_HALVES = (1 << 16, 1 << 16)
# Areas 1-899 without 666, groups 1-99 with serials 1-9999.
SSN_HALVES = (898, 99 * 9999)


def chars(text: Column) -> Column:
    return F.when(F.length(text) == 0, F.array().cast("array<string>")).otherwise(
        F.transform(F.sequence(F.lit(1), F.length(text)), lambda i: F.substring(text, i, F.lit(1)))
    )


def digest(key: str, kind: str, turn: Column, value: Column) -> Column:
    """64 hexadecimal digits from the key, the kind, the round and a value."""
    words = F.concat_ws("|", F.lit(key), F.lit(kind), turn.cast("string"), value.cast("string"))
    return F.sha2(words.cast("binary"), 256)


def permute_number(value: Column, halves: tuple[int, int], key: str, kind: str) -> Column:
    """A keyed permutation of 0 .. a * b - 1: value = left * b + right, each half shifted in turn."""
    a, b = halves
    start = F.struct(F.floor(value / b).cast("bigint").alias("left"), F.pmod(value, F.lit(b)).cast("bigint").alias("right"))

    def drawn(turn: Column, other: Column) -> Column:
        return F.conv(F.substring(digest(key, kind, turn, other), 1, 15), 16, 10).cast("bigint")

    def step(state: Column, turn: Column) -> Column:
        left, right = state["left"], state["right"]
        return F.when(
            turn % 2 == 0,
            F.struct(F.pmod(left + drawn(turn, right), F.lit(a)).cast("bigint").alias("left"), right.alias("right")),
        ).otherwise(
            F.struct(left.alias("left"), F.pmod(right + drawn(turn, left), F.lit(b)).cast("bigint").alias("right"))
        )

    return F.aggregate(
        F.sequence(F.lit(1), F.lit(ROUNDS)), start, step, lambda state: state["left"] * F.lit(b) + state["right"]
    )


def shift(char: Column, amount: Column) -> Column:
    """The character ``amount`` places on among digits, small or capital letters; others stay."""
    code = F.ascii(char)
    moved = char
    for first, size in ((48, 10), (65, 26), (97, 26)):
        inside = (code >= first) & (code < first + size)
        moved = F.when(inside, F.chr((code - first + amount) % size + first)).otherwise(moved)
    return moved


def permute_text(text: Column, key: str, kind: str) -> Column:
    """A keyed permutation of the texts of one format: the halves are shifted by each other in turn."""
    middle = F.floor(F.length(text) / 2).cast("int")
    start = F.struct(
        F.substring(text, F.lit(1), middle).alias("left"),
        F.substring(text, middle + 1, F.length(text)).alias("right"),
    )

    def moved(half: Column, other: Column, turn: Column) -> Column:
        # The digest is bound once; its bytes repeat for halves over 32 characters.
        by = F.transform(
            F.array(digest(key, kind, turn, other)),
            lambda d: F.array_join(
                F.transform(
                    chars(half),
                    lambda c, i: shift(c, F.conv(F.substring(d, i % 32 * 2 + 1, F.lit(2)), 16, 10).cast("int")),
                ),
                "",
            ),
        )
        return by[0]

    def step(state: Column, turn: Column) -> Column:
        left, right = state["left"], state["right"]
        return F.when(
            turn % 2 == 0, F.struct(moved(left, right, turn).alias("left"), right.alias("right"))
        ).otherwise(F.struct(left.alias("left"), moved(right, left, turn).alias("right")))

    return F.aggregate(
        F.sequence(F.lit(1), F.lit(ROUNDS)), start, step, lambda state: F.concat(state["left"], state["right"])
    )


def put_back(found: Column, letters: str, replaced: Column) -> Column:
    """``found`` with its characters of the class ``letters`` replaced in order by those of ``replaced``."""
    return F.array_join(
        F.transform(
            chars(found),
            lambda c, i: F.when(
                c.rlike(f"^{letters}$"),
                F.substring(
                    replaced, F.length(F.regexp_replace(F.substring(found, F.lit(1), i + 1), f"(?!{letters}).", "")), F.lit(1)
                ),
            ).otherwise(c),
        ),
        "",
    )


def let(value: Column, body) -> Column:
    """``body`` of a value that is computed once."""
    return F.transform(F.array(value), body)[0]


def digits_of(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def luhn_sum(digits: Column, odd: int) -> Column:
    """Sum of the digits, those at every second place from the right doubled (starting at place ``odd``)."""
    return F.aggregate(
        F.transform(
            chars(F.reverse(digits)),
            lambda c, i: F.when(
                i % 2 == odd, F.when(c.cast("int") > 4, c.cast("int") * 2 - 9).otherwise(c.cast("int") * 2)
            ).otherwise(c.cast("int")),
        ),
        F.lit(0),
        lambda total, x: total + x,
    )


def card(found: Column, key: str) -> Column:
    """A number with valid check digit."""

    def changed(digits: Column) -> Column:
        payload = F.substring(digits, F.lit(1), F.length(digits) - 1)
        return let(
            permute_text(payload, key, "card"),
            lambda p: F.concat(p, F.pmod(F.lit(10) - luhn_sum(p, 0) % 10, F.lit(10)).cast("string")),
        )

    return let(digits_of(found), lambda d: put_back(found, "[0-9]", changed(d)))


def mod_97(text: Column) -> Column:
    """Remainder of the number that letters (A = 10 ... Z = 35) and digits spell."""
    return F.aggregate(
        chars(text),
        F.lit(0),
        lambda rest, c: F.when(F.ascii(c) < 65, (rest * 10 + c.cast("int")) % 97).otherwise(
            (rest * 100 + F.ascii(c) - 55) % 97
        ).cast("int"),
    )


def iban(found: Column, key: str) -> Column:
    """A number with valid check digits."""

    def changed(plain: Column) -> Column:
        country = F.substring(plain, 1, 2)
        return let(
            permute_text(F.substring(plain, F.lit(5), F.length(plain)), key, "iban"),
            lambda p: F.concat(
                country, F.lpad((98 - mod_97(F.concat(p, country, F.lit("00")))).cast("string"), 2, "0"), p
            ),
        )

    return let(
        F.regexp_replace(found, " ", ""),
        lambda plain: put_back(found, "[A-Z0-9]", changed(plain)),
    )


def ip(found: Column, key: str) -> Column:
    def changed(parts: Column) -> Column:
        value = F.aggregate(parts, F.lit(0).cast("bigint"), lambda total, x: total * 256 + x.cast("bigint"))
        return let(
            permute_number(value, IP_HALVES, key, "ip"),
            lambda n: F.concat_ws(
                ".", *[F.pmod(F.shiftright(n, bits), F.lit(256)).cast("string") for bits in (24, 16, 8, 0)]
            ),
        )

    return let(
        F.split(found, r"\."),
        lambda parts: F.when(F.forall(parts, lambda x: x.cast("int") <= 255), changed(parts)).otherwise(found),
    )


def ssn(found: Column, key: str) -> Column:
    area, group, serial = (F.split(found, "-")[i].cast("bigint") for i in range(3))
    valid = area.between(1, 899) & (area != 666) & (group > 0) & (serial > 0)
    place = F.when(area > 666, area - 2).otherwise(area - 1)
    inner = SSN_HALVES[1]
    return F.when(
        valid,
        let(
            permute_number(place * inner + (group - 1) * 9999 + serial - 1, SSN_HALVES, key, "ssn"),
            lambda n: let(
                F.floor(n / inner),
                lambda a: F.concat_ws(
                    "-",
                    F.lpad((a + F.when(a >= 665, 2).otherwise(1)).cast("string"), 3, "0"),
                    F.lpad((F.floor(n % inner / 9999) + 1).cast("string"), 2, "0"),
                    F.lpad((n % inner % 9999 + 1).cast("string"), 4, "0"),
                ),
            ),
        ),
    ).otherwise(found)


def date(found: Column, key: str) -> Column:
    """Dates of 1900 to 2099; days come first in dd.mm.yyyy and dd-mm-yyyy, months in mm/dd/yyyy unless only
    the other reading is a date."""

    def day(form: str) -> Column:
        return F.try_to_timestamp(found, F.lit(form)).cast("date")

    def written(form: str) -> Column:
        value = day(form)
        offset = F.datediff(value, F.lit(FIRST_DAY).cast("date")).cast("bigint")
        moved = permute_number(offset, DAY_HALVES, key, "date")
        return F.when(
            found.rlike(shapes[form]) & F.year(value).between(1900, 2099),
            F.date_format(F.date_add(F.lit(FIRST_DAY).cast("date"), moved.cast("int")), form),
        )

    shapes = {
        "yyyy-MM-dd": "^....-", "yyyy/MM/dd": "^..../", "dd.MM.yyyy": r"^..[.]..[.]", "dd-MM-yyyy": "^..-..-",
        "MM/dd/yyyy": "^../../", "dd/MM/yyyy": "^../../",
    }
    return F.coalesce(*[written(form) for form in shapes], found)


def phone(found: Column, key: str) -> Column:
    """All digits but a country code after a plus sign, if there are 7 to 15 in all."""
    code = F.length(F.regexp_extract(found, r"^\+([0-9]{1,3})", 1))
    # Without a separator behind it the country code cannot be told apart, so only one digit is kept.
    code = F.when(found.rlike(r"^\+[0-9]{1,3}[ .(-]"), code).when(found.startswith("+"), 1).otherwise(0)
    return let(
        digits_of(found),
        lambda d: F.when(
            F.length(d).between(7, 15),
            put_back(
                found,
                "[0-9]",
                F.concat(F.substring(d, F.lit(1), code), permute_text(F.substring(d, code + 1, F.length(d)), key, "phone")),
            ),
        ).otherwise(found),
    )


def email(found: Column, key: str) -> Column:
    """The part before the @; the host stays."""
    at = F.instr(found, "@")
    return F.concat(
        permute_text(F.substring(found, F.lit(1), at - 1), key, "email"), F.substring(found, at, F.length(found))
    )


# Account and card numbers are chosen in runs and changed there.
PSEUDONYMS = {"email": email, "ip": ip, "date": date, "ssn": ssn, "phone": phone}


def kind_of(found: Column) -> Column:
    """The kind of a find; "run" for groups in which account and card numbers are still to be chosen.

    Looking around is left out, since the find has no surroundings any more.
    """
    kind = F.lit("run")
    for name, pattern in reversed(FORMATS.items()):
        kind = F.when(found.rlike(f"^(?:{pattern})$"), name).otherwise(kind)
    return F.when(found.contains("@"), "email").when(found.rlike("^[A-Z]"), "run").otherwise(kind)


def number_rank(text: Column) -> Column:
    """0 to 3 if groups are one valid account or card number, the surest first, else null."""

    def rank(plain: Column) -> Column:
        country, size = F.substring(plain, 1, 2), F.length(plain)
        listed = F.lit(False)
        for length, countries in IBAN_LENGTHS.items():
            listed = listed | ((size == length) & country.isin(countries.split()))
        rotated = F.concat(F.substring(plain, F.lit(5), size), F.substring(plain, 1, 4))
        return F.when(
            text.rlike("^[A-Z]{2}[0-9]{2}[A-Z0-9 ]*$") & size.between(12, 35),
            F.when(mod_97(rotated) == 1, F.when(listed, 0).otherwise(2)),
        ).when(
            text.rlike("^[0-9 -]+$") & size.between(13, 19),
            F.when(luhn_sum(plain, 1) % 10 == 0, F.when(text.rlike(CARD_GROUPS), 1).otherwise(3)),
        )

    return let(F.regexp_replace(text, "[ -]", ""), rank)


def numbers_in(run: Column) -> Column:
    """Array of (start, end) of the account and card numbers in a run, in order; they begin and end with groups.

    Of numbers that overlap the surer one is taken, then the one further left, then the longer one.
    """

    def bounds(groups: Column) -> Column:
        empty = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,end:int>>").alias("all"))

        def step(acc: Column, group: Column) -> Column:
            end = acc["at"] + F.length(group)
            one = F.struct(acc["at"].alias("start"), end.alias("end"))
            return F.struct((end + 1).alias("at"), F.concat(acc["all"], F.array(one)).alias("all"))

        return F.aggregate(groups, empty, step, lambda acc: acc["all"])

    def spans(groups: Column) -> Column:
        # An account number has 35 characters at most, so no more groups than that count.
        return F.flatten(
            F.transform(
                groups,
                lambda first, i: F.transform(
                    F.filter(F.slice(groups, i + 1, F.lit(35)), lambda last: last["end"] - first["start"] <= 69),
                    lambda last: F.struct(
                        number_rank(F.substring(run, first["start"] + 1, last["end"] - first["start"])).alias("rank"),
                        first["start"].alias("start"), (-last["end"]).alias("until"), last["end"].alias("end"),
                    ),
                ),
            )
        )

    def take(taken: Column, x: Column) -> Column:
        free = ~F.exists(taken, lambda t: (t["start"] < x["end"]) & (x["start"] < t["end"]))
        return F.when(
            free, F.concat(taken, F.array(F.struct(x["start"].alias("start"), x["end"].alias("end"))))
        ).otherwise(taken)

    valid = F.filter(let(bounds(F.split(run, "[ -]")), spans), lambda x: x["rank"].isNotNull())
    none = F.array().cast("array<struct<start:int,end:int>>")
    return F.array_sort(F.aggregate(F.array_sort(valid), none, take))


def part(kind: Column, found: Column, pseudonym: Column) -> Column:
    return F.struct(kind.alias("kind"), found.alias("found"), pseudonym.alias("pseudonym"))


def parts_of(found: Column, key: str) -> Column:
    """Array of (kind, found, pseudonym) that make up a find; the kind of what lies between numbers is null.

    A run without a valid number is one find, its own pseudonym.
    """
    kind_if_none = F.when(found.rlike("^[A-Z]"), "iban").otherwise("card")
    nothing = F.lit(None).cast("string")

    def number(text: Column) -> Column:
        is_iban = text.rlike("^[A-Z]")
        return part(
            F.when(is_iban, "iban").otherwise("card"),
            text,
            F.when(is_iban, iban(text, key)).otherwise(card(text, key)),
        )

    def split_up(numbers: Column) -> Column:
        def piece(start: Column, end: Column) -> Column:
            return let(F.substring(found, start + 1, end - start), lambda text: part(nothing, text, text))

        def one(x: Column, i: Column) -> Column:
            before = F.when(i == 0, F.lit(0)).otherwise(F.get(numbers, i - 1)["end"])
            text = F.substring(found, x["start"] + 1, x["end"] - x["start"])
            return F.array(piece(before, x["start"]), let(text, number))

        last = F.element_at(numbers, -1)["end"]
        return F.when(F.size(numbers) == 0, F.array(part(kind_if_none, found, found))).otherwise(
            F.concat(F.flatten(F.transform(numbers, one)), F.array(piece(last, F.length(found))))
        )

    def whole(kind: Column) -> Column:
        result = found
        for name, make in PSEUDONYMS.items():
            result = F.when(kind == name, make(found, key)).otherwise(result)
        return F.when(kind == "run", let(numbers_in(found), split_up)).otherwise(F.array(part(kind, found, result)))

    return let(kind_of(found), whole)


def finds(text: Column, key: str = KEY) -> Column:
    """Array of all finds, each an array of (kind, found, pseudonym) as of ``parts_of``."""
    found = (
        F.when(text.contains("@"), F.regexp_extract_all(text, F.lit(PATTERN), F.lit(0)))
        .when(text.rlike("[0-9]"), F.regexp_extract_all(text, F.lit(NUMBER), F.lit(0)))
        .when(text.isNotNull(), F.array().cast("array<string>"))
    )
    return F.transform(found, lambda m: parts_of(m, key))


def spans_of(text: Column, found: Column) -> Column:
    """Array of (kind, start, end, changed) of the finds, in code points, end exclusive."""
    pieces = F.split(text, PATTERN, -1)
    state = F.struct(
        F.lit(0).alias("at"), F.array().cast("array<struct<kind:string,start:int,end:int,changed:boolean>>").alias("spans")
    )

    def step(acc: Column, x: Column) -> Column:
        end = acc["at"] + F.length(x["found"])
        span = F.struct(
            x["kind"].alias("kind"), acc["at"].alias("start"), end.alias("end"),
            (x["found"] != x["pseudonym"]).alias("changed"),
        )
        spans = F.when(x["kind"].isNotNull(), F.concat(acc["spans"], F.array(span))).otherwise(acc["spans"])
        return F.struct(end.alias("at"), spans.alias("spans"))

    nothing = F.lit(None).cast("string")
    parts = F.flatten(
        F.zip_with(pieces, found, lambda p, x: F.concat(F.array(part(nothing, p, p)), F.coalesce(x, F.array())))
    )
    return F.aggregate(parts, state, step, lambda acc: acc["spans"])


def rewritten(text: Column, found: Column) -> Column:
    """The text with every find replaced by its pseudonym."""
    pieces = F.split(text, PATTERN, -1)
    joined = F.zip_with(pieces, found, lambda p, x: F.concat(p, F.coalesce(F.array_join(x["pseudonym"], ""), F.lit(""))))
    return F.when(F.size(found) > 0, F.array_join(joined, "")).otherwise(text)


def pseudonymised(docs: DataFrame, text_col: str = "text", key: str = KEY) -> DataFrame:
    """The rows of ``docs`` with the text rewritten; all other columns stay."""
    whole = docs.select(F.struct("*").alias("row"), finds(F.col(text_col), key).alias("found"))
    changed = F.col("row").withField(f"`{text_col}`", rewritten(F.col(f"row.`{text_col}`"), F.col("found")))
    return whole.select(changed.alias("row")).select("row.*")


def pseudonyms(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", key: str = KEY) -> DataFrame:
    """``id_col``, ``text`` (rewritten), ``n_found`` (candidates), ``n_changed`` and ``spans``, comma-joined
    kind:start:end of those changed, in code points of the given text."""
    named = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_given"))
    found = named.withColumn("_found", finds(F.col("_given"), key))
    spanned = found.withColumn(
        "_spans", F.when(F.size("_found") > 0, F.filter(spans_of(F.col("_given"), F.col("_found")), lambda s: s["changed"]))
    )
    spans = F.transform("_spans", lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"]))
    return spanned.select(
        F.col("_id").alias(id_col),
        rewritten(F.col("_given"), F.col("_found")).alias("text"),
        F.coalesce(F.size(F.filter(F.flatten("_found"), lambda x: x["kind"].isNotNull())), F.lit(0)).cast("bigint").alias("n_found"),
        F.coalesce(F.size("_spans"), F.lit(0)).cast("bigint").alias("n_changed"),
        F.coalesce(F.array_join(spans, ","), F.lit("")).alias("spans"),
    )
