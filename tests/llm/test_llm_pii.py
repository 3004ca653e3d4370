"""Pseudonyms: format, validity, linkage, bijection, and nothing else changed."""

import datetime
import hashlib
import random
import re

from cases import documents, odd_documents
from peerbench.llm.pii import DAY_HALVES, KEY, pseudonymised, pseudonyms
from pyspark.sql import functions as F
from peerbench.llm.pii import permute_number, permute_text


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def iban_ok(text):
    plain = text.replace(" ", "")
    return int("".join(str(int(c, 36)) for c in plain[4:] + plain[:4])) % 97 == 1


def changed(spark, texts, key=KEY):
    rows = [(i, t, None, None, None) for i, t in enumerate(texts)]
    return {r.doc_id: r for r in pseudonyms(documents(spark, rows), key=key).collect()}


def card(random_):
    payload = "4" + "".join(random_.choices("0123456789", k=14))
    return next(payload + c for c in "0123456789" if luhn(payload + c))


def test_every_kind_keeps_its_form(spark):
    random_ = random.Random(1)
    number = card(random_)
    dashed = "-".join(number[i : i + 4] for i in range(0, 16, 4))
    cases = [
        ("jane.doe42@mail.example.com", r"[a-z]{4}\.[a-z]{3}[0-9]{2}@mail\.example\.com"),
        ("+1 (017) 555-7713", r"\+1 \([0-9]{3}\) [0-9]{3}-[0-9]{4}"),
        ("(555) 123-4567", r"\([0-9]{3}\) [0-9]{3}-[0-9]{4}"),
        ("+33 1 23 45 67 89", r"\+33 [0-9] [0-9]{2} [0-9]{2} [0-9]{2} [0-9]{2}"),
        ("97.51.17.173", r"[0-9]+(\.[0-9]+){3}"),
        (number, r"[0-9]{16}"),
        (dashed, r"[0-9]{4}(-[0-9]{4}){3}"),
        ("DE89 3704 0044 0532 0130 00", r"DE[0-9]{2}( [0-9]{4}){4} [0-9]{2}"),
        ("GB82WEST12345698765432", r"GB[0-9]{2}[A-Z]{4}[0-9]{14}"),
        ("123-45-6789", r"[0-9]{3}-[0-9]{2}-[0-9]{4}"),
        ("2024-02-29", r"[0-9]{4}-[0-9]{2}-[0-9]{2}"),
        ("31.12.1999", r"[0-9]{2}\.[0-9]{2}\.[0-9]{4}"),
        ("1999/12/31", r"[0-9]{4}/[0-9]{2}/[0-9]{2}"),
    ]
    found = changed(spark, [f"é see {value}, then {value}." for value, _ in cases])
    for i, (value, shape) in enumerate(cases):
        m = re.fullmatch(r"é see (.*), then (.*)\.", found[i].text)
        assert m and m[1] == m[2] != value and re.fullmatch(shape, m[1]), (value, found[i].text)
        assert found[i].n_found == found[i].n_changed == 2
        spans = [s.split(":") for s in found[i].spans.split(",")]
        given = f"é see {value}, then {value}."
        assert [given[int(s) : int(e)] for _, s, e in spans] == [value, value]
    one, two = (re.search(r"see (.*), then", found[i].text)[1] for i in (5, 6))
    assert one == two.replace("-", "") and luhn(one)
    assert iban_ok(re.search("see (.*), then", found[7].text)[1]) and iban_ok(re.search("see (.*), then", found[8].text)[1])
    assert all(int(x) < 256 for x in re.search("see (.*), then", found[4].text)[1].split("."))


def test_dates_agree_in_all_forms(spark):
    found = changed(spark, ["1999-12-31 31.12.1999 31-12-1999 12/31/1999 31/12/1999 1999/12/31"])[0].text.split()
    forms = ["%Y-%m-%d", "%d.%m.%Y", "%d-%m-%Y", "%m/%d/%Y", "%d/%m/%Y", "%Y/%m/%d"]
    days = {datetime.datetime.strptime(x, f).date() for x, f in zip(found, forms)}
    assert len(days) == 1


def test_what_is_not_valid_stays(spark):
    texts = ["1234567890123456", "300.1.1.1", "1.2.3.4.5", "x1.2.3.4", "000-12-1234", "666-12-1234", "2023-02-29"]
    texts += ["1899-01-01", "XX00ABCD12345678", "a@b", "12345678", "v2.0", "1234567890123456789012", "99/99/2001"]
    found = changed(spark, texts)
    assert [found[i].text for i in range(len(texts))] == texts
    assert {r.n_changed for r in found.values()} == {0}


def test_numbers_without_two_adjacent_digits(spark):
    values = ["8.8.8.8", "+1 2 3 4 5 6 7 8", "4 1 1 1 1 1 1 1 1 1 1 1 1 1 1 1"]
    alone = [f"ask {v} now" for v in values]
    # An address of e-mail lets every text be searched for everything.
    searched = [f"ask {v} now a@b.example.com" for v in values]
    found = changed(spark, alone + searched)
    for i, value in enumerate(values):
        assert found[i].n_changed == 1 and value not in found[i].text
        assert found[i].text == found[i + len(values)].text.rsplit(" ", 1)[0]


def test_numbers_beside_other_groups(spark):
    plain, spaced, dashed = "4111111111111111", "4111 1111 1111 1111", "4111-1111-1111-1111"
    spanish, austrian, german = "ES9121000418450200051332", "AT611904300234573201", "DE89 3704 0044 0532 0130 00"
    spelled = " ".join(plain)
    cases = [
        (f"{spaced} 12/26", [spaced]), (f"{plain} 12/26", [plain]), (f"{spaced} 123", [spaced]),
        (f"order 7 {spaced}", [spaced]), (f"paid 25 {dashed}", [dashed]), (f"7 8 9 10 11 12 13 {spaced} 9", [spaced]),
        (f"{spanish} EUR", [spanish]), (f"{austrian} BIC", [austrian]), (f"{german} 2500 EUR", [german]),
        (f"AB12 {spanish} {dashed}", [spanish, dashed]), (f"{spaced} 378282246310005 1", [spaced, "378282246310005"]),
        (f"{spaced} 2026-12-31 {spaced}", [spaced, "2026-12-31", spaced]), (f"{plain} 123-45-6789", [plain, "123-45-6789"]),
        (f"{plain} 8.8.8.8", [plain, "8.8.8.8"]), (f"+1 (017) 555-7713 {spaced}", ["+1 (017) 555-7713", spaced]),
        (f"{german} JOHN.DOE@X.COM", [german, "JOHN.DOE@X.COM"]), (f"card {spelled}", [spelled]),
        (f"{spaced} 2x", [spaced]), (f"DE12 {spaced} 12/26", [spaced]),
    ]
    values = sorted({v for _, own in cases for v in own})
    found = changed(spark, [text for text, _ in cases] + values)
    single = {v: found[len(cases) + i].text for i, v in enumerate(values)}
    for i, (text, own) in enumerate(cases):
        spans = [tuple(map(int, s.split(":")[1:])) for s in found[i].spans.split(",")]
        assert [text[a:b] for a, b in spans] == own, (text, found[i].spans)
        for a, b in reversed(spans):
            text = text[:a] + single[text[a:b]] + text[b:]
        assert found[i].text == text
        assert found[i].n_found == found[i].n_changed == len(own)


def test_long_runs(spark):
    found = changed(spark, ["0000 " * 400 + "end", "1" * 100_000, "A1 " * 2000, "AB12 " * 500])
    assert [found[i].n_changed for i in (1, 2)] == [0, 0]


class Slow:
    """The pseudonyms of single values, computed one by one in plain Python."""

    def __init__(self, key):
        self.key = key

    def digest(self, kind, turn, value):
        return hashlib.sha256(f"{self.key}|{kind}|{turn}|{value}".encode()).hexdigest()

    def number(self, value, halves, kind):
        left, right = divmod(value, halves[1])
        for turn in range(1, 9):
            if turn % 2:
                right = (right + int(self.digest(kind, turn, left)[:15], 16)) % halves[1]
            else:
                left = (left + int(self.digest(kind, turn, right)[:15], 16)) % halves[0]
        return left * halves[1] + right

    def letters(self, text, kind):
        def moved(half, other, turn):
            by = bytes.fromhex(self.digest(kind, turn, other))
            out = ""
            for i, c in enumerate(half):
                for alphabet in ("0123456789", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"):
                    if c in alphabet:
                        c = alphabet[(alphabet.index(c) + by[i % 32]) % len(alphabet)]
                        break
                out += c
            return out

        left, right = text[: len(text) // 2], text[len(text) // 2 :]
        for turn in range(1, 9):
            if turn % 2:
                right = moved(right, left, turn)
            else:
                left = moved(left, right, turn)
        return left + right

    def put_back(self, found, allowed, new):
        new = iter(new)
        return "".join(next(new) if c in allowed else c for c in found)

    def email(self, value):
        name, host = value.split("@")
        return self.letters(name, "email") + "@" + host

    def ip(self, value):
        n = self.number(int.from_bytes(map(int, value.split("."))), (1 << 16, 1 << 16), "ip")
        return ".".join(map(str, n.to_bytes(4)))

    def date(self, value, form):
        first = datetime.date(1900, 1, 1)
        day = datetime.datetime.strptime(value, form).date()
        return (first + datetime.timedelta(self.number((day - first).days, DAY_HALVES, "date"))).strftime(form)

    def ssn(self, value):
        area, group, serial = map(int, value.split("-"))
        area -= 2 if area > 666 else 1
        n = self.number(area * 99 * 9999 + (group - 1) * 9999 + serial - 1, (898, 99 * 9999), "ssn")
        area, rest = divmod(n, 99 * 9999)
        return f"{area + (2 if area >= 665 else 1):03d}-{rest // 9999 + 1:02d}-{rest % 9999 + 1:04d}"

    def card(self, value):
        digits = re.sub("[^0-9]", "", value)
        payload = self.letters(digits[:-1], "card")
        return self.put_back(value, "0123456789", next(payload + c for c in "0123456789" if luhn(payload + c)))

    def iban(self, value):
        plain = value.replace(" ", "")
        rest = self.letters(plain[4:], "iban")
        check = next(f"{n:02d}" for n in range(2, 99) if iban_ok(plain[:2] + f"{n:02d}" + rest))
        return self.put_back(value, "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ", plain[:2] + check + rest)

    def phone(self, value):
        digits = re.sub("[^0-9]", "", value)
        code = len(re.match(r"\+([0-9]{1,3})[ .(-]", value)[1]) if value.startswith("+") else 0
        return self.put_back(value, "0123456789", digits[:code] + self.letters(digits[code:], "phone"))


def planted(random_, slow):
    """A value of a random kind and its pseudonym."""
    digits = lambda n: "".join(random_.choices("0123456789", k=n))
    kind = random_.choice(["email", "ip", "date", "ssn", "card", "iban", "phone"])
    if kind == "email":
        name = "".join(random_.choices("abcXYZ019._-", k=random_.randint(1, 40))).strip(".") or "a"
        value = f"{name}@{random_.choice(['x.org', 'mail.example.com'])}"
    elif kind == "ip":
        value = ".".join(str(random_.randint(0, 255)) for _ in range(4))
    elif kind == "date":
        day = datetime.date(1900, 1, 1) + datetime.timedelta(random_.randrange(17 * 4297))
        form = random_.choice(["%Y-%m-%d", "%Y/%m/%d", "%d.%m.%Y", "%d-%m-%Y", "%m/%d/%Y"])
        return (value := day.strftime(form)), slow.date(value, form)
    elif kind == "ssn":
        area = random_.choice([x for x in range(1, 900) if x != 666])
        value = f"{area:03d}-{random_.randint(1, 99):02d}-{random_.randint(1, 9999):04d}"
    elif kind == "card":
        plain = card(random_)
        value = random_.choice(["", " ", "-"]).join(plain[i : i + 4] for i in range(0, 16, 4))
    elif kind == "iban":
        country, rest = random_.choice([("DE", digits(18)), ("ES", digits(20)), ("GB", "WEST" + digits(14))])
        plain = next(x for n in range(2, 99) if iban_ok(x := f"{country}{n:02d}{rest}"))
        value = random_.choice([plain, " ".join(plain[i : i + 4] for i in range(0, len(plain), 4))])
    else:
        value = random_.choice([f"+{random_.randint(1, 99)} {digits(3)} {digits(3)} {digits(4)}", f"({digits(3)}) {digits(3)}-{digits(4)}"])
    return value, getattr(slow, kind)(value)


def test_planted_values_equal_a_plain_computation(spark):
    random_, slow = random.Random(21), Slow("a secret")
    texts, expected, counts = [], [], []
    for _ in range(400):
        text = wanted = ""
        n = random_.randint(0, 4)
        for _ in range(n):
            word = random_.choice(["see", "über", "note", "日本", "call;"])
            value, pseudonym = planted(random_, slow)
            end = random_.choice([" ok, ", "; then ", ")\n", " x\t"])
            text, wanted = text + f"{word} {value}{end}", wanted + f"{word} {pseudonym}{end}"
        texts.append(text)
        expected.append(wanted)
        counts.append(n)
    found = changed(spark, texts, "a secret")
    for i, text in enumerate(texts):
        assert found[i].text == expected[i], (text, found[i].text, expected[i])
        assert found[i].n_found == counts[i]


def test_another_key_gives_other_pseudonyms(spark):
    text = "97.51.17.173 jane.doe42@mail.example.com"
    assert changed(spark, [text])[0].text != changed(spark, [text], "other")[0].text


def test_permutations_are_one_to_one(spark):
    a, b = DAY_HALVES
    numbers = spark.range(a * b).select(permute_number(F.col("id"), DAY_HALVES, "k", "t").alias("n"))
    row = numbers.agg(F.min("n"), F.max("n"), F.count_distinct("n")).first()
    assert tuple(row) == (0, a * b - 1, a * b)
    texts = spark.range(1000).select(permute_text(F.lpad(F.col("id").cast("string"), 3, "0"), "k", "t").alias("t"))
    assert texts.distinct().count() == 1000
    assert all(re.fullmatch("[0-9]{3}", r.t) for r in texts.collect())


def test_odd_documents_are_unchanged(spark):
    docs = documents(spark, clashing=True)
    hidden = pseudonymised(docs)
    assert hidden.columns == docs.columns
    key = lambda r: [(v is None, str(v)) for v in r]
    assert sorted(hidden.collect(), key=key) == sorted(docs.collect(), key=key)
    assert len(pseudonyms(docs).collect()) == len(odd_documents())


def test_columns_stay_when_text_changes(spark):
    docs = documents(spark, [(1, "at 97.51.17.173", "en", "a", 15)], clashing=True)
    row = pseudonymised(docs).first().asDict()
    assert row.pop("text") != "at 97.51.17.173"
    given = docs.first().asDict()
    given.pop("text")
    assert row == given


def test_empty_table(spark):
    assert pseudonyms(documents(spark, [])).collect() == []
    assert pseudonymised(documents(spark, [])).collect() == []
