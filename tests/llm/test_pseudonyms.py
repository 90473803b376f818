import hashlib
import random
import re
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from turnweave.llm import pseudonyms
from turnweave.llm.pseudonyms import found, pseudonymize


def luhn(number):
    values = [int(c) for c in number if c.isdigit()][::-1]
    return sum(v if i % 2 == 0 else 2 * v - 9 * (v > 4) for i, v in enumerate(values)) % 10 == 0


def cards(count, draw):
    for _ in range(count):
        body = "".join(str(draw.randrange(10)) for _ in range(15))
        yield next(body + str(c) for c in range(10) if luhn(body + str(c)))


def both(spark, texts, **options):
    options = {"key": "a key", **options}
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    there = pseudonymize(rows, **options)
    back = pseudonymize(there, back=True, **options)
    return [[r.text for r in f.orderBy("doc_id").collect()] for f in (there, back)]


def test_formats_and_round_trip(spark):
    draw = random.Random(1)
    days = [date(1800, 1, 1) + timedelta(draw.randrange(146097)) for _ in range(40)]
    values = [*cards(40, draw), *map(str, days), *(d.strftime("%d.%m.%Y") for d in days[:9])]
    values += [f"{draw.randrange(256)}.{draw.randrange(256)}.{draw.randrange(256)}.{draw.randrange(256)}" for _ in range(40)]
    values += [f"+1 ({draw.randrange(100, 1000)}) 555-{draw.randrange(1000, 10000)}" for _ in range(40)]
    values += ["078-05-1120", "DE89370400440532013000", "GB29 NWBK 6016 1331 9268 19", "ab.12@mail1.example.com"]
    texts = [f"It says {v}, twice {v}." for v in values]
    there, back = both(spark, texts)
    assert back == texts
    made = []
    for value, text in zip(values, there):
        first, second = re.fullmatch(r"It says (.*), twice (.*)\.", text).groups()
        assert first == second
        shape = lambda v: re.sub("[0-9]", "9", re.sub("[a-z]", "a", v))
        if not re.fullmatch(r"[0-9.]+", value) or re.fullmatch(r"\d\d\.\d\d\.\d{4}", value):
            assert re.sub("[A-Z]", "", shape(first)) == re.sub("[A-Z]", "", shape(value))
        made.append(first)
    assert all(map(luhn, made[:40])) and len(set(made)) == len(set(values))
    assert sum(a == b for a, b in zip(made, values)) <= 1
    for text in made[40:80]:
        date.fromisoformat(text)


def test_what_fails_its_check_stays(spark):
    texts = ["4111111111111112", "2023-02-30", "300.1.2.3", "666-12-3456", "DE00370400440532013000", "no 12345", "", None]
    there, _ = both(spark, texts)
    assert there == texts


def test_keys_and_links(spark):
    text = "4111 1111 1111 1111 and 4111-1111-1111-1111"
    one, two = both(spark, [text])[0][0], both(spark, [text], key="other")[0][0]
    assert one != two
    spaced, dashed = one.split(" and ")
    assert spaced.replace(" ", "") == dashed.replace("-", "")


def test_odd_tables(odd, nothing):
    kept = pseudonymize(odd, key="k")
    assert kept.columns == odd.columns
    assert kept.exceptAll(odd).count() == odd.exceptAll(kept).count() == 0
    assert pseudonymize(nothing, key="k").count() == 0
    assert odd.select(F.sum(found("text"))).first()[0] == 0
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def mod_97(account):
    moved = account[4:] + account[:4]
    return int("".join(str(int(c, 36)) for c in moved)) % 97


def account(draw, country, size):
    body = "".join(draw.choice("0123456789") for _ in range(size - 4))
    return next(f"{country}{n:02d}{body}" for n in range(2, 99) if mod_97(f"{country}{n:02d}{body}") == 1)


def test_no_valid_value_stays_whatever_stands_around_it(spark):
    draw = random.Random(5)
    values = []
    for number in cards(6, draw):
        values += [number, " ".join(number[i : i + 4] for i in range(0, 16, 4)), "-".join(number[i : i + 4] for i in range(0, 16, 4))]
    amex = next(f"3{n:013d}{c}" for n in [draw.randrange(10**13)] for c in range(10) if luhn(f"3{n:013d}{c}"))
    values += [amex, f"{amex[:4]} {amex[4:10]} {amex[10:]}"]
    for country, size in (("BE", 16), ("DE", 22), ("GB", 22), ("FR", 27), ("NO", 15)):
        whole = account(draw, country, size)
        values += [whole, " ".join(whole[i : i + 4] for i in range(0, size, 4))]
    values += ["2023-01-05", "24.12.1999", "12/31/2020", "078-05-1120", "10.1.2.3", "(743) 555-3824", "+1 (743) 555-3824", "jo.doe9@mail5.example.com"]
    around = [" 12/27", " 123", " 12", " IN euros", " INTEREST", " OK", ", 4", " 2023-01-05", " 4111 1111 1111 1111", " 99 99", "; x@y.org", "\ue000", "."]
    before = ["", "12 ", "1234 12 ", "AB12 ", "OK ", "No. ", "4111 1111 1111 1111 ", "2023-01-05 ", "\ue000", "("]
    texts = [f"{b}{v}{a}" for v in values for b, a in [(before[0], x) for x in around] + [(x, around[-1]) for x in before]]
    there, _ = both(spark, texts)
    kept = [(text, made) for text, made, value in zip(texts, there, [v for v in values for _ in range(len(around) + len(before))]) if value in made]
    # One in many pseudonyms may be its own value.
    assert len(kept) <= 2, kept[:10]


def test_marks_in_a_text_stay(spark):
    texts = ["\ue000", "a\ue000b\ue001c\ue002", "\ue0004111 1111 1111 1112\ue001", "\ue000\ue002"]
    assert both(spark, texts)[0] == texts


def network(value, kind, tweak, key, back=False):
    """The Feistel network in plain Python."""
    half = len(value) // 2
    left, right = value[:half], value[half:]

    def moved(text, other, step, sign):
        h = hashlib.sha256(f"{key}|{kind}|{step}|{tweak}|{other}".encode()).hexdigest()
        out = ""
        for j, c in enumerate(text):
            amount = sign * int(h[2 * (j % 32) : 2 * (j % 32) + 2], 16)
            for first, size in (("0", 10), ("a", 26), ("A", 26)):
                if 0 <= ord(c) - ord(first) < size:
                    c = chr(ord(first) + (ord(c) - ord(first) + amount) % size)
                    break
            out += c
        return out

    for step in range(8, 0, -1) if back else range(1, 9):
        if back:
            left, right = moved(right, left, step, -1), left
        else:
            left, right = right, moved(left, right, step, 1)
    return left + right


def test_network_against_plain_python(spark):
    draw = random.Random(9)
    names = ["a", "ab", "jo.doe9", "x1", "very.long.name.with.many.letters.and.99"] + ["".join(draw.choice("abz09.") for _ in range(9)).strip(".") + "q" for _ in range(20)]
    there, back = both(spark, [f"{n}@mail.example.com" for n in names], key="s")
    assert [t.split("@")[0] for t in there] == [network(n, "mail", "mail.example.com", "s") for n in names]
    assert [t.split("@")[0] for t in back] == names
    numbers = list(cards(20, draw))
    there, _ = both(spark, numbers, key="s")
    assert [t[:-1] for t in there] == [network(n[:-1], "card", "", "s") for n in numbers]


def test_key_is_needed(spark):
    with pytest.raises(ValueError):
        pseudonymize(spark.createDataFrame([("a",)], "text string"), key="")


def test_long_runs_of_groups(spark):
    number = next(cards(1, random.Random(3)))
    text = "12 " * 3000 + number + " 12" * 3000
    there, _ = both(spark, [text])
    assert number not in there[0] and len(there[0]) == len(text)


def plain_pattern():
    """What is looked for, without any look at how a value begins."""
    mail = r"[A-Za-z0-9](?:[A-Za-z0-9._%+-]{0,62}[A-Za-z0-9])?@(?:[A-Za-z0-9](?:[A-Za-z0-9-]{0,61}[A-Za-z0-9])?\.)+[A-Za-z]{2,24}"
    kinds = "|".join([pseudonyms.IBAN, mail, *(pattern for pattern, _ in pseudonyms.KINDS[1:])])
    return f"{pseudonyms.LEFT}(?:{kinds}){pseudonyms.RIGHT}|{pseudonyms.LEFT}(?:{pseudonyms.DIGITS})"


ODD_PIECES = [
    *("4111 1111 1111 1111", "4111111111111111", "DE89370400440532013000", "GB29 NWBK 6016 1331 9268 19", "2023-01-05", "24.12.1999", "078-05-1120"),
    *("10.1.2.3", "(743) 555-3824", "+1 (743) 555-3824", "743-555-3824", "jo.doe9@mail5.example.com", "a@b.co", "a.@b.com", "-a@b.com", "a@b..com", "1.2.3.4@x.org"),
    *("a" * 63 + "@q.com", "a" * 64 + "@q.com", "a" * 65 + "@q.com", "a" + "." * 62 + "b@q.com", "a" + "." * 63 + "b@q.com", "@", "+", "(", "-", ".", " ", " ", "NO", "DE12", "12", "word", "é", "\n"),
    *("", "", "", "12"),
]


def test_looking_at_the_start_loses_and_adds_nothing():
    draw, plain, values = random.Random(4), re.compile(plain_pattern()), 0
    with_mail, without = map(re.compile, pseudonyms.ANY)
    for _ in range(20000):
        text = "".join(draw.choice(ODD_PIECES) + draw.choice(["", " ", " "]) for _ in range(draw.randrange(9)))
        expected = [m.span() for m in plain.finditer(text)]
        assert [m.span() for m in (with_mail if "@" in text else without).finditer(text)] == expected, text
        values += len(expected)
    assert values > 10000


def test_texts_without_values_are_not_searched_again(spark):
    draw = random.Random(6)
    texts = ["".join(draw.choice(ODD_PIECES) + draw.choice(["", " "]) for _ in range(draw.randrange(7))) for _ in range(400)]
    rows = spark.createDataFrame([*enumerate(texts), (400, None), (401, ""), (402, None), (403, "")], "doc_id long, text string")
    counted = rows.withColumn("n", found("text"))
    searched, known = (df.orderBy("doc_id").collect() for df in (pseudonymize(counted, key="k"), pseudonymize(counted, key="k", n_found="n")))
    assert searched == known
    plain = re.compile(plain_pattern())
    assert [r.n for r in known] == [len(plain.findall(t)) for t in texts] + [0] * 4
    assert all(r.text == t for r, t in zip(known, texts) if not r.n)
    # The count is trusted, a null one too.
    told = spark.createDataFrame([("10.1.2.3", 0), ("10.1.2.3", None), ("10.1.2.3", 1)], "text string, n int")
    assert [r.text == "10.1.2.3" for r in pseudonymize(told, key="k", n_found="n").collect()] == [True, True, False]


def test_each_pass_searches_a_text_once():
    for patterns in (pseudonyms.ACCOUNTS, pseudonyms.NUMBERS, pseudonyms.OTHERS):
        made = pseudonyms._replaced("t", patterns, "upper(m)")
        assert [made.count(pseudonyms._text(pattern)) for pattern in patterns] == [1] * len(patterns)
