"""Pseudonyms that keep the format of personal numbers, dates and mail addresses.

Each value that passes its check (check digits, ranges, calendar) is permuted by a keyed Feistel
network among the values of its format: equal values get equal pseudonyms everywhere, different
ones different, and whoever has the key can turn them back. All of it is SQL expressions.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: An even number, so that the halves end where they began.
ROUNDS = 8
#: 400 years, after which the calendar repeats: 189 * 773 days.
FIRST_DAY, DAY_ROWS, DAY_COLUMNS = "1800-01-01", 189, 773

# What may be personal. Values are told apart again by the same patterns, whole.
# The name before an @ is possessive: behind a shorter one is no @, so the engine need not try it.
MAIL = r"[A-Za-z0-9][A-Za-z0-9._%+-]{0,63}+(?<=[A-Za-z0-9])@(?:[A-Za-z0-9](?:[A-Za-z0-9-]{0,61}[A-Za-z0-9])?\.)+[A-Za-z]{2,24}"
#: Groups of digits that may hold card numbers, as far as they go; groups that are part of something else
#: are left out. Possessive, as the engine would otherwise keep a frame for each group.
_GROUP = r"[0-9]++(?![A-Za-z@]|\.[0-9])"
DIGITS = rf"(?=[0-9](?:[ -]?[0-9]){{12}}){_GROUP}(?:[ -]{_GROUP})*+"
CARD_SIZES, USUAL_CARD = (13, 19), 16
PHONE = r"(?:\+[0-9]{1,3}[ .-]?)?(?:\([0-9]{3}\) ?|[0-9]{3}[.-])[0-9]{3}[ .-][0-9]{4}|\+[0-9]{1,3}(?:[ .-]?[0-9]{2,4}){2,5}"
ADDRESS = r"[0-9]{1,3}(?:\.[0-9]{1,3}){3}"
SOCIAL = r"[0-9]{3}-[0-9]{2}-[0-9]{4}"
DATE = r"[0-9]{4}-[0-9]{2}-[0-9]{2}|[0-9]{2}\.[0-9]{2}\.[0-9]{4}|[0-9]{2}/[0-9]{2}/[0-9]{4}"
# How long the account numbers of each country are.
IBAN_SIZES = {
    15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH HR LI LV",
    22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG",
    25: "LY PT ST", 26: "IS TR", 27: "BI DJ FR GR IT MC MR SM", 28: "AL AZ BY CY DO GT HU LB NI PL SV",
    29: "BR PS QA UA", 30: "JO KW MU YE", 31: "MT SC", 32: "LC", 33: "RU",
}
IBAN = "|".join(f"(?:{'|'.join(countries.split())})[0-9]{{2}}(?: ?[A-Z0-9]){{{size - 4}}}" for size, countries in IBAN_SIZES.items())
#: What each kind begins with, mail addresses aside. A search looks at this first, as few places of a text begin a value.
IBAN_START, DIGITS_START, START = "[A-Z][A-Z][0-9][0-9]", "[0-9]", "[0-9(+]"
LEFT, RIGHT = r"(?<![A-Za-z0-9])(?<![0-9][.,-])(?<!\+)", r"(?![A-Za-z0-9@]|[.-][0-9])"
#: Around what a pass has replaced, so that later ones leave it alone; a mark in a text is followed by ``ESCAPE``.
MARK, END, ESCAPE = "\ue000", "\ue001", "\ue002"
#: Number n says that n groups of digits are one number.
CODES = "".join(chr(0xE010 + n) for n in range(CARD_SIZES[1] + 1))
MARKED = f"{MARK}[^{END}{ESCAPE}]+{END}"
#: Around each match of a search. No text has two marks in a row: behind a mark is an escape or a value. No match begins or ends right behind a mark.
BORDER = MARK * 2


def _guarded(pattern: str, right: str = RIGHT) -> str:
    return f"{LEFT}(?:{pattern}){right}"


def _starting(start: str, pattern: str) -> str:
    """The pattern, tried only where ``start`` stands."""
    return f"(?={start})(?:{pattern})"


def _text(value: str) -> str:
    """A string literal."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


@dataclass(frozen=True)
class Permutation:
    """The keyed permutations, as SQL over SQL; ``back`` turns values back."""

    key: str
    back: bool = False

    def __post_init__(self):
        if not self.key:
            raise ValueError("pseudonyms need a secret key")

    def _digest(self, kind: str, step: str, half: str) -> str:
        return f"sha2(concat({_text(f'{self.key}|{kind}|')}, {step}, '|', {half}), 256)"

    def _steps(self) -> str:
        return f"sequence({ROUNDS}, 1)" if self.back else f"sequence(1, {ROUNDS})"

    def letters(self, value: str, kind: str, tweak: str = "''") -> str:
        """Digits stay digits, letters letters of their case, other characters themselves.

        Each ``tweak`` has a permutation of its own.
        """
        sign = "-" if self.back else "+"
        fixed, moved = ("l", "r") if self.back else ("r", "l")
        digest = self._digest(kind, "i", f"{tweak}, '|', s.{fixed}")
        amount = f"{sign} CAST(conv(substr(h, 2 * pmod(j - 1, 32) + 1, 2), 16, 10) AS INT)"
        shifted = " ".join(
            f"WHEN substr(v, j, 1) BETWEEN '{first}' AND '{last}' THEN chr({ord(first)} + pmod(ascii(substr(v, j, 1)) - {ord(first)} {amount}, {size}))"
            for first, last, size in (("0", "9", 10), ("a", "z", 26), ("A", "Z", 26))
        )
        # Names for a value within an expression: a one-element array and its transform.
        change = (
            f"IF(length(s.{moved}) = 0, '', transform(array(named_struct('v', s.{moved}, 'h', {digest})), "
            f"x -> array_join(transform(sequence(1, length(x.v)), j -> CASE {shifted.replace('(v,', '(x.v,').replace('(h,', '(x.h,')} ELSE substr(x.v, j, 1) END), ''))[0])"
        )
        after = f"'l', {change}, 'r', s.l" if self.back else f"'l', s.r, 'r', {change}"
        # Backwards a step undoes (l, r) -> (r, l shifted by r).
        half = f"CAST(floor(length({value}) / 2) AS INT)"
        return (
            f"aggregate({self._steps()}, named_struct('l', substr({value}, 1, {half}), 'r', substr({value}, {half} + 1)), "
            f"(s, i) -> named_struct({after}), s -> concat(s.l, s.r))"
        )

    def pair(self, left: str, right: str, size_left: int, size_right: int, kind: str) -> str:
        """A struct (l, r) of two numbers below the given sizes, permuted among all such pairs."""
        sign = "-" if self.back else "+"

        def moved(fixed: str, step: str) -> str:
            return f"CAST(conv(substr({self._digest(kind, step, f'CAST({fixed} AS STRING)')}, 1, 12), 16, 10) AS BIGINT)"

        l_step = f"named_struct('l', pmod(s.l {sign} {moved('s.r', 'i')}, {size_left}L), 'r', s.r)"
        r_step = f"named_struct('l', s.l, 'r', pmod(s.r {sign} {moved('s.l', 'i')}, {size_right}L))"
        return (
            f"aggregate({self._steps()}, named_struct('l', CAST({left} AS BIGINT), 'r', CAST({right} AS BIGINT)), "
            f"(s, i) -> IF(i % 2 = 1, {l_step}, {r_step}))"
        )


def digits(value: str) -> str:
    return f"regexp_replace({value}, '[^0-9]', '')"


def luhn_sum(number: str, doubled: int) -> str:
    """Digit sum with every second digit doubled, counted from the right from place ``doubled``."""
    digit = f"CAST(substr(reverse({number}), k, 1) AS INT)"
    return (
        f"aggregate(sequence(1, length({number})), 0, (t, k) -> t + "
        f"IF(k % 2 = {doubled % 2}, {digit} * 2 - IF({digit} > 4, 9, 0), {digit}))"
    )


def refilled(form: str, figures: str) -> str:
    """``form`` with its digits replaced by those of ``figures``, in order."""
    before = f"length(regexp_replace(substr({form}, 1, j), '[^0-9]', ''))"
    return f"array_join(transform(sequence(1, length({form})), j -> IF(substr({form}, j, 1) BETWEEN '0' AND '9', substr({figures}, {before}, 1), substr({form}, j, 1))), '')"


def named(value: str, name: str, expression: str) -> str:
    """``expression`` with ``name`` standing for ``value``, which is computed once."""
    return f"transform(array({value}), {name} -> {expression})[0]"


def card(m: str, p: Permutation) -> str:
    body = "substr(c, 1, length(c) - 1)"
    permuted = p.letters(body, "card")
    check = f"pmod(10 - pmod({luhn_sum('q', 1)}, 10), 10)"
    whole = named(permuted, "q", f"concat(q, CAST({check} AS STRING))")
    return named(digits(m), "c", named(whole, "w", refilled(m, "w")))


def cards(m: str, p: Permutation) -> str:
    """Groups of digits with the card numbers among them replaced.

    Before each group goes a code: how many groups from there on pass the check together, those of the
    usual length or else of the greatest. Coded groups are then read from left to right. So what
    stands before or behind a number does not hide it, and the work grows with the number of groups.
    """
    least, most = CARD_SIZES
    number = digits("array_join(slice(h, 1, n), '')")
    passes = f"length(c) BETWEEN {least} AND {most} AND pmod({luhn_sum('c', 2)}, 10) = 0"
    sizes = f"filter(transform(sequence(1, size(h)), n -> transform(array({number}), c -> IF({passes}, named_struct('usual', length(c) = {USUAL_CARD}, 'size', length(c), 'n', n), NULL))[0]), x -> x IS NOT NULL)"
    code = f"substr('{CODES}', coalesce(array_max({sizes}).n, 0) + 1, 1)"
    coded = f"array_join(transform(g, (x, i) -> concat({named(f'slice(g, i + 1, {most})', 'h', code)}, x)), '')"
    # A code for n groups takes the codes of those groups with it.
    spans = "|".join(f"{CODES[n]}[0-9]+(?:[ -][{CODES}][0-9]+){{{n - 1}}}" for n in range(most, 0, -1))
    replaced = _replaced("u", (spans,), named(f"translate(m, '{CODES}', '')", "v", marked(card("v", p))))
    return named(f"regexp_extract_all({m}, '[0-9]+[ -]?', 0)", "g", named(coded, "u", f"translate({replaced}, '{CODES}', '')"))


def phone(m: str, p: Permutation) -> str:
    prefix = f"regexp_extract({m}, '^(\\\\+[0-9]{{1,3}}[ .-]|\\\\+1(?=[(0-9]))', 1)"
    rest = named(f"substr({m}, length(a) + 1)", "b", named(p.letters("g", "phone"), "w", refilled("b", "w")).join(["transform(array(" + digits("b") + "), g -> ", ")[0]"]))
    return named(prefix, "a", f"IF(length({digits(m)}) BETWEEN 7 AND 15, concat(a, {rest}), {m})")


def address(m: str, p: Permutation) -> str:
    def octet(k: int) -> str:
        return f"CAST(o[{k}] AS BIGINT)"

    pair = p.pair(f"{octet(0)} * 256 + {octet(1)}", f"{octet(2)} * 256 + {octet(3)}", 65536, 65536, "address")
    text = "concat_ws('.', CAST(q.l AS BIGINT) DIV 256, q.l % 256, q.r DIV 256, q.r % 256)"
    valid = " AND ".join(f"{octet(k)} <= 255" for k in range(4))
    return named(f"split({m}, '[.]')", "o", f"IF({valid}, {named(pair, 'q', text)}, {m})")


def social(m: str, p: Permutation) -> str:
    area, group, serial = (f"CAST(o[{k}] AS BIGINT)" for k in range(3))
    valid = f"{area} BETWEEN 1 AND 899 AND {area} <> 666 AND {group} > 0 AND {serial} > 0"
    left = f"({area} - IF({area} > 666, 2, 1)) * 99 + {group} - 1"
    pair = p.pair(left, f"{serial} - 1", 898 * 99, 9999, "social")
    back = "q.l DIV 99"
    text = f"concat_ws('-', lpad(CAST({back} + IF({back} >= 665, 2, 1) AS STRING), 3, '0'), lpad(CAST(q.l % 99 + 1 AS STRING), 2, '0'), lpad(CAST(q.r + 1 AS STRING), 4, '0'))"
    return named(f"split({m}, '-')", "o", f"IF({valid}, {named(pair, 'q', text)}, {m})")


def _mod_97(code: str) -> str:
    value = f"IF(substr({code}, k, 1) BETWEEN '0' AND '9', ascii(substr({code}, k, 1)) - 48, ascii(substr({code}, k, 1)) - 55)"
    return f"aggregate(sequence(1, length({code})), 0, (t, k) -> pmod(t * IF({value} > 9, 100, 10) + {value}, 97))"


def iban(m: str, p: Permutation) -> str:
    body = p.letters("substr(c, 5)", "iban")
    moved = "concat(q, substr(c, 1, 2), '00')"
    check = f"lpad(CAST(98 - {named(moved, 'z', _mod_97('z'))} AS STRING), 2, '0')"
    whole = named(body, "q", f"concat(substr(c, 1, 2), {check}, q)")
    spaced = f"array_join(transform(sequence(1, length({m})), j -> IF(substr({m}, j, 1) = ' ', ' ', substr(w, length(replace(substr({m}, 1, j), ' ', '')), 1))), '')"
    valid = named("concat(substr(c, 5), substr(c, 1, 4))", "z", _mod_97("z"))
    return named(f"replace({m}, ' ', '')", "c", f"IF({valid} = 1, {marked(named(whole, 'w', spaced))}, {m})")


def date(m: str, p: Permutation) -> str:
    forms = ((r"^[0-9]{4}-", "yyyy-MM-dd"), (r"[.]", "dd.MM.yyyy"), ("/", "MM/dd/yyyy"))
    pattern = "CASE " + " ".join(f"WHEN {m} RLIKE {_text(sign)} THEN '{form}'" for sign, form in forms) + " END"
    parsed = "CASE " + " ".join(f"WHEN f = '{form}' THEN CAST(try_to_timestamp({m}, '{form}') AS DATE)" for _, form in forms) + " END"
    pair = p.pair(f"n DIV {DAY_COLUMNS}", f"n % {DAY_COLUMNS}", DAY_ROWS, DAY_COLUMNS, "date")
    day = f"date_add(DATE '{FIRST_DAY}', CAST(q.l * {DAY_COLUMNS} + q.r AS INT))"
    text = "CASE " + " ".join(f"WHEN f = '{form}' THEN date_format({day}, '{form}')" for _, form in forms) + " END"
    valid = f"n BETWEEN 0 AND {DAY_ROWS * DAY_COLUMNS - 1}"
    number = named(f"datediff({parsed}, DATE '{FIRST_DAY}')", "n", f"IF(coalesce({valid}, false), {named(pair, 'q', text)}, {m})")
    return named(pattern, "f", number)


def mail(m: str, p: Permutation) -> str:
    local = f"lower(substring_index({m}, '@', 1))"
    # Names are permuted per domain, so that short ones are not all shifted alike.
    permuted = named(local, "c", p.letters("c", "mail", f"lower(substring_index({m}, '@', -1))"))
    return f"concat({permuted}, '@', substring_index({m}, '@', -1))"


KINDS = ((MAIL, mail), (DATE, date), (SOCIAL, social), (ADDRESS, address), (PHONE, phone))
# Only a digit, ( or + begins a value that is no mail address, so texts without an @ are searched for those alone.
_OTHERS = _starting(START, "|".join(pattern for pattern, _ in KINDS[1:]))
_WITH_MAIL = f"{MAIL}|{_OTHERS}"
_ACCOUNTS, _NUMBERS = _starting(IBAN_START, IBAN), _starting(DIGITS_START, DIGITS)
#: What each pass looks for. Account numbers go first, as their check is the strongest, and mail addresses last.
#: Of two patterns, the first is for texts with an @ and the second for those without.
ACCOUNTS = (_starting(IBAN_START, _guarded(IBAN)),)
NUMBERS = (_starting(f"[{MARK}0-9]", f"{MARKED}|{_guarded(DIGITS, '')}"),)
OTHERS = (f"{MARKED}|{_guarded(_WITH_MAIL)}", _starting(f"[{MARK}0-9(+]", f"{MARKED}|{_guarded(_OTHERS)}"))
#: What any of them looks for.
ANY = (
    _guarded(f"(?:{_ACCOUNTS}|{_WITH_MAIL}){RIGHT}|{_NUMBERS}", ""),
    _starting("[A-Z0-9(+]", _guarded(f"(?:{_ACCOUNTS}|{_OTHERS}){RIGHT}|{_NUMBERS}", "")),
)


def marked(value: str) -> str:
    return f"concat('{MARK}', {value}, '{END}')"


def unmarked(m: str, otherwise: str) -> str:
    """What an earlier pass has replaced, without its marks in the last pass."""
    return f"IF(startswith({m}, '{MARK}'), {m}, {otherwise})"


def pseudonym(m: str, p: Permutation) -> str:
    """The pseudonym of one value that the last pass has found; itself if no check is passed."""
    cases = " ".join(f"WHEN {m} RLIKE {_text(f'^(?:{pattern})$')} THEN {make(m, p)}" for pattern, make in KINDS)
    return f"CASE WHEN startswith({m}, '{MARK}') THEN substr({m}, 2, length({m}) - 2) {cases} ELSE {m} END"


def _replaced(t: str, patterns: tuple[str, ...], made: str) -> str:
    """The text with every match ``m`` of the pattern replaced by ``made``.

    Of two patterns, the first is for texts with an @ and the second for those without. The text is searched
    once: the search sets each match off, so that every second part is one.
    """
    searched = [f"regexp_replace({t}, {_text(pattern)}, '{BORDER}$0{BORDER}')" for pattern in patterns]
    parted = searched[0] if len(searched) == 1 else f"IF(contains({t}, '@'), {searched[0]}, {searched[1]})"
    joined = f"array_join(transform(split(parted, '{BORDER}'), (m, i) -> IF(i % 2 = 1, {made}, m)), '')"
    return named(parted, "parted", f"IF(contains(parted, '{BORDER}'), {joined}, parted)")


def pseudonymized(text: Column | str, key: str, back: bool = False) -> Column:
    """The text with each personal value replaced by its pseudonym; with ``back`` the other way."""
    name = text if isinstance(text, str) else text._jc.toString()
    p = Permutation(key, back)
    out = _replaced("t2", OTHERS, pseudonym("m", p))
    out = named(_replaced("t1", NUMBERS, unmarked("m", cards("m", p))), "t2", out)
    out = named(_replaced("t0", ACCOUNTS, iban("m", p)), "t1", out)
    out = named(f"replace({name}, '{MARK}', '{MARK}{ESCAPE}')", "t0", out)
    return F.expr(f"replace({out}, '{MARK}{ESCAPE}', '{MARK}')")


def found(text: str) -> Column:
    """How many values the patterns find, whether they pass a check or not."""
    value = F.col(f"`{text}`")
    with_mail, without = (F.regexp_count(value, F.lit(pattern)) for pattern in ANY)
    return F.coalesce(F.when(value.contains("@"), with_mail).otherwise(without), F.lit(0)).cast("bigint")


def pseudonymize(docs: DataFrame, text: str = "text", *, key: str, back: bool = False, n_found: str | None = None) -> DataFrame:
    """The documents with pseudonyms in ``text``; other columns, order and number of rows stay.

    Mail addresses keep their domain; their local part is taken in lower case. Numbers keep
    separators and length: card numbers their check digit rule, phone numbers a country prefix,
    social numbers and IP addresses their ranges, IBANs country and check rule. Dates from 1800 to
    2199 become such dates. What looks like one but fails its check stays, and so do null and
    empty texts. Numbers in a row of digit groups are found whatever stands around them; where such
    a row reads as two numbers of different length, the usual length counts, in either direction, so
    turning a text back may take another reading of it. Nothing is shuffled. With ``n_found``, a column
    that holds what ``found`` counts in ``text``, texts in which nothing was found are not searched again.
    """
    made = pseudonymized(f"`{text}`", key, back)
    if n_found is not None:
        made = F.when(F.col(f"`{n_found}`") > 0, made).otherwise(F.col(f"`{text}`"))
    return docs.withColumn(text, made)
