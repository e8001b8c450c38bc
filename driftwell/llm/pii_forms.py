"""Forms of personal data: the four base kinds, the generators of further candidates, their features, and examples.

Plain helpers over one text; offsets are code points, ends exclusive. All searches take time linear in the text.
"""

from __future__ import annotations

import random
import re
from bisect import bisect_right

Span = tuple[int, int, int]  # start, end, kind

#: The base kinds in report order, then the kinds that only the classifier adds.
BASE = ("email", "ip", "card", "phone")
ADDED = ("written_email", "local_phone", "card_part", "ssn", "iban", "ipv6")
KINDS = BASE + ADDED

LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
DIGITS = re.compile(r"[0-9]+")
PHONE = re.compile(r"[0-9]([\x20().0-9-]+)")
AT = re.compile(r"[\x20(\[{<](?:[aA][tT]|@)(?=[\x20)\]}>])")
WRITTEN = re.compile(r"[)\]}>]?\x20?[A-Za-z0-9-]+(?:(?:\x20?[(\[{<]\x20?(?:[dD][oO][tT]|\.)\x20?[)\]}>]\x20?|\x20[dD][oO][tT]\x20|\.)[A-Za-z0-9-]+)+")
IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?(?![A-Za-z0-9])")
IPV6 = re.compile(r"(?<![0-9A-Za-z:.])(?:[0-9A-Fa-f]{0,4}:){2,7}[0-9A-Fa-f]{0,4}(?![0-9A-Za-z:])")

#: Words that announce personal data, words that announce other numbers, and common ends of host names.
PERSONAL = ("phone", "tel", "call", "fax", "mobile", "handy", "anruf", "appel", "llam", "móvil", "mail", "contact", "kontakt", "reach", "card", "visa", "karte", "carte", "tarjeta", "ssn", "social", "iban", "account", "konto", "compte", "cuenta", "address", "host", "client", "from ip", "login")
OTHER = ("order", "no.", "nr.", "ref", "invoice", "version", "isbn", "page", "total", "serial", "token", "commit", "item", "part", "build", "article", "rev", "date", "sku", "key", "hash", "$", "€", "£", "%", "time", "::", "doi")
ENDS = frozenset("com org net edu gov info biz io dev app co uk de fr es it nl eu us ca au ch at be pl ru jp cn in br mx test example invalid".split())


def luhn(digits: str) -> bool:
    total = sum(int(c) for c in digits[-1::-2]) + sum(int(c) * 2 - 9 * (c > "4") for c in digits[-2::-2])
    return total % 10 == 0


def iban_holds(text: str) -> bool:
    flat = text.replace(" ", "")
    return int("".join(str(int(c, 36)) for c in flat[4:] + flat[:4])) % 97 == 1


def ssn_holds(digits: str) -> bool:
    return digits[:3] not in ("000", "666") and digits[0] != "9" and digits[3:5] != "00" and digits[5:] != "0000"


def emails(text: str) -> list[Span]:
    """From each @: the name to its left, not beyond the last match, and the longest host to its right."""
    out, free, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > free and text[start - 1] in LOCAL:
            start -= 1
        host = DOMAIN.match(text, at + 1) if start < at else None
        if host:
            out.append((start, host.end(), 0))
        # What lies left of this @ and was no match cannot be one for a later @, as no name holds an @.
        free = host.end() if host else at + 1
        at = text.find("@", free)
    return out


def chains(text: str, runs: list[tuple[int, int]], gaps: str) -> list[list[tuple[int, int]]]:
    """Runs of digits, cut where anything but one character of ``gaps`` lies between two."""
    out: list[list[tuple[int, int]]] = []
    for run in runs:
        if out and run[0] == out[-1][-1][1] + 1 and text[run[0] - 1] in gaps:
            out[-1].append(run)
        else:
            out.append([run])
    return out


def addresses(text: str, runs: list[tuple[int, int]]) -> list[Span]:
    out = []
    for chain in chains(text, runs, "."):
        for i in range(0, len(chain) - 3, 4):
            parts = [text[s:e].lstrip("0") for s, e in chain[i : i + 4]]
            if all(len(p) <= 3 and int(p or 0) <= 255 for p in parts):
                out.append((chain[i][0], chain[i + 3][1], 1))
    return out


def cards(text: str, runs: list[tuple[int, int]]) -> list[Span]:
    out = []
    for chain in chains(text, runs, " -"):
        if 14 <= sum(e - s for s, e in chain) <= 19 and luhn("".join(text[s:e] for s, e in chain)):
            out.append((chain[0][0], chain[-1][1], 2))
    return out


def phones(text: str) -> list[Span]:
    out, at = [], text.find("+")
    while at >= 0:
        m = PHONE.match(text, at + 1)
        if m:
            found = m[0].rstrip(" ().-")
            if len(found) >= 3 and 10 <= sum(map(len, DIGITS.findall(found))) <= 15:
                out.append((at, at + 1 + len(found), 3))
        at = text.find("+", at + 1)
    return out


def base(text: str, runs: list[tuple[int, int]] | None = None) -> list[Span]:
    """Leftmost matches per kind that pass their tests, by start, then kind."""
    runs = [m.span() for m in DIGITS.finditer(text)] if runs is None else runs
    return sorted(emails(text) + addresses(text, runs) + cards(text, runs) + phones(text), key=lambda s: (s[0], s[2]))


def _word(text: str, at: int) -> bool:
    return 0 <= at < len(text) and (text[at].isalnum() or text[at] == "_")


def numbers(text: str, runs: list[tuple[int, int]]) -> list[Span]:
    """Windows of up to five digit runs, at most three characters of ``().-/ `` apart, that stand as words of their own."""
    out, n = [], len(runs)
    for i, (start, first) in enumerate(runs):
        if _word(text, start - 1):
            continue
        opened = start - 1 if start and text[start - 1] == "(" else start
        lengths: list[int] = []
        for j in range(i, min(i + 5, n)):
            s, e = runs[j]
            if j > i and (s - runs[j - 1][1] > 3 or text[runs[j - 1][1] : s].strip("().-/ ")):
                break
            lengths.append(e - s)
            total = sum(lengths)
            if total > 19:
                break
            if _word(text, e):
                continue
            gaps = {text[runs[k][1] : runs[k + 1][0]] for k in range(i, j)}
            if 10 <= total <= 15 and (len(lengths) > 1 or text.startswith("00", start)):
                out.append((opened if ")" in text[opened:e] else start, e, KINDS.index("local_phone")))
            if 14 <= total <= 19 and lengths in ([total], [4] * 4, [4, 6, 5]) and len(gaps) < 2 and gaps <= {" ", "-"}:
                out.append((start, e, KINDS.index("card_part")))
            if lengths == [3, 2, 4] and gaps in ({"-"}, {" "}):
                out.append((start, e, KINDS.index("ssn")))
    return out


def written_emails(text: str) -> list[Span]:
    out = []
    for m in AT.finditer(text):
        start = m.start()
        if text[start] != " " and start and text[start - 1] == " ":
            start -= 1
        end = start
        while start and end - start < 64 and text[start - 1] in LOCAL:
            start -= 1
        host = WRITTEN.match(text, m.end()) if start < end else None
        if host:
            out.append((start, host.end(), KINDS.index("written_email")))
    return out


def proposals(text: str, runs: list[tuple[int, int]] | None = None) -> list[Span]:
    """High-recall candidates, which may overlap; what they are worth is for the classifier to say."""
    runs = [m.span() for m in DIGITS.finditer(text)] if runs is None else runs
    out = numbers(text, runs) + written_emails(text)
    out += [(*m.span(), KINDS.index("iban")) for m in IBAN.finditer(text)]
    if "::" in text or text.count(":") > 6:
        out += [(*m.span(), KINDS.index("ipv6")) for m in IPV6.finditer(text) if m[0].strip(":")]
    return sorted(out)


FEATURES = (
    *ADDED, "length", "digits", "letters", "marks", "runs", "first_run", "last_run", "kinds_of_gap", "distinct", "luhn", "iban", "ssn", "opened", "zeros", "year", "brackets", "dots", "known_end",
    "short_host", "colons", "double_colon", "hex_letters", "widest_group", "before_space", "before_quote", "before_sign", "after_space", "after_mark", "personal", "other", "digits_before", "digits_after", "joined_before", "joined_after", "second_run", "trunk",
)


def features(text: str, span: Span) -> list[float]:
    """Format of the span, then its context: neighbours, announcing words and digits nearby."""
    start, end, kind = span
    s = text[start:end]
    digits = "".join(c for c in s if c in "0123456789")
    runs = DIGITS.findall(s)
    gaps = {g for g in DIGITS.split(s)[1:-1]}
    tail = re.split(r"[^A-Za-z0-9]+", s)[-1].lower()
    before, after = text[max(0, start - 48) : start].lower(), text[end : end + 24]
    prev, follow = text[start - 1 : start], text[end : end + 1]
    near = re.split(r"\s+", before)[-7:]
    announced = " ".join(near)
    return [
        *(float(kind == KINDS.index(k)) for k in ADDED),
        len(s), len(digits), sum(map(str.isalpha, s)), sum(not c.isalnum() and c != " " for c in s), len(runs), len(runs[0]) if runs else 0, len(runs[-1]) if runs else 0, len(gaps),
        len(set(digits)), float(len(digits) > 1 and luhn(digits)), float(kind == KINDS.index("iban") and iban_holds(s)), float(len(digits) == 9 and ssn_holds(digits)), float(s[:1] == "("), float(s[:2] == "00"),
        float(bool(runs) and len(runs[0]) == 4 and runs[0][:2] in ("19", "20")), sum(c in "()[]{}<>" for c in s), len(re.findall(r"(?i)\bdot\b", s)), float(tail in ENDS), float(len(tail) < 4),
        s.count(":"), float("::" in s), sum(c in "abcdefABCDEF" for c in s), max(map(len, re.split(r"[^A-Za-z0-9]+", s))),
        float(prev in ("", " ", "\n", "\t")), float(prev in ("'", '"', "=", "`")), float(prev in ("#", "$", "€", "/", "-", ".", ",")), float(follow in ("", " ", "\n", "\t", ".", ",", ";", ")")), float(follow in ("'", '"', "-", "/", "%", ":")),
        sum(w in announced for w in PERSONAL), sum(w in announced for w in OTHER), sum(c.isdigit() for c in before[-20:]), sum(c.isdigit() for c in after[:20]),
        float(before.rstrip("().-/ +")[-1:].isdigit() and len(before) - len(before.rstrip("().-/ +")) < 4), float(after.lstrip("().-/ +")[:1].isdigit() and len(after) - len(after.lstrip("().-/ +")) < 4),
        len(runs[1]) if len(runs) > 1 else 0, float(s[:1] == "0" and s[1:2] != "0"),
    ]


def _digits(rng: random.Random, n: int) -> str:
    return "".join(rng.choice("0123456789") for _ in range(n))


def _card(rng: random.Random, valid: bool = True) -> str:
    head = rng.choice("3456") + _digits(rng, 14)
    good = next(c for c in "0123456789" if luhn(head + c))
    return head + (good if valid else str((int(good) + rng.randint(1, 9)) % 10))


def _number(rng: random.Random, n: int) -> str:
    """Digits that are no card number, as one in ten would be."""
    while luhn(d := _digits(rng, n)):
        pass
    return d


def _fours(d: str) -> str:
    return " ".join(d[i : i + 4] for i in range(0, len(d), 4))


def _iban(rng: random.Random, valid: bool = True) -> str:
    country, body = rng.choice(("DE", "FR", "ES", "GB", "NL", "CH")), _digits(rng, rng.randint(12, 20))
    check = 98 - int("".join(str(int(c, 36)) for c in body + country + "00")) % 97
    flat = country + f"{check if valid else (check + rng.randint(1, 90)) % 97 + 1:02d}" + body
    return flat if rng.random() < 0.5 else _fours(flat)


def _ssn(rng: random.Random) -> str:
    while not ssn_holds(d := _digits(rng, 9)):
        pass
    return "-".join((d[:3], d[3:5], d[5:]))


def _name(rng: random.Random) -> str:
    return "".join(rng.choice("abcdefghiklmnoprstuvwz") for _ in range(rng.randint(2, 8)))


def _mail(rng: random.Random) -> str:
    opened, shut = rng.choice(((" ", " "), (" (", ") "), ("(", ")"), (" [", "] ")))
    dot = rng.choice((f"{opened}dot{shut}", ".")) if opened != " " else " dot "
    hosts = [_name(rng) for _ in range(rng.randint(1, 2))] + [rng.choice(sorted(ENDS))]
    return _name(rng) + rng.choice(("", ".", "_")) + _name(rng) + rng.choice(("", _digits(rng, 2))) + f"{opened}at{shut}" + dot.join(hosts)


def _phone(rng: random.Random) -> str:
    a, b, c = str(rng.randint(200, 999)), _digits(rng, 3), _digits(rng, 4)
    area, line = rng.choice("123456789") + _digits(rng, rng.randint(1, 3)), _digits(rng, rng.randint(7, 8))
    abroad = (f"00{rng.randint(1, 99)} {area} {line}", f"0{area} {line}", f"0{area}/{line}")
    return rng.choice((f"({a}) {b}-{c}", f"{a}-{b}-{c}", f"{a}.{b}.{c}", f"{a} {b} {c}", f"1-{a}-{b}-{c}", *abroad))


def _ipv6(rng: random.Random) -> str:
    groups = [f"{rng.randrange(1 << 16):x}" for _ in range(8)]
    i = rng.randint(1, 6)
    return ":".join(groups) if rng.random() < 0.5 else ":".join(groups[:i]) + "::" + ":".join(groups[i + 1 : rng.randint(i + 2, 8)])


def example(rng: random.Random) -> tuple[str, str, bool]:
    """(words or a number before, a string written by rule, whether it is personal data)."""
    if rng.random() < 0.5:
        make = rng.choice((_mail, _phone, _phone, _card, _ssn, _iban, _ipv6))
        cues = ("", "", rng.choice(PERSONAL) + rng.choice((": ", " ")), *([_card(rng, rng.random() < 0.5) + " "] if make is _card else []))
        return rng.choice(cues), make(rng), True
    d = _digits
    day = f"{rng.randint(1900, 2099)}-{rng.randint(1, 12):02d}-{rng.randint(1, 28):02d}"
    made = (
        lambda: f"{day} {rng.randint(0, 23):02d}", lambda: f"{day} - {day}", lambda: f"{day.replace('-', '.')} {d(rng, 4)}", lambda: _card(rng, False), lambda: f"{_card(rng, False)} {_card(rng, False)}",
        lambda: _fours(_number(rng, 16)), lambda: _number(rng, rng.randint(10, 18)), lambda: f"978-{d(rng, 1)}-{d(rng, 2)}-{d(rng, 6)}-{d(rng, 1)}", lambda: _iban(rng, False),
        lambda: f"{rng.choice(('000', '666', '9' + d(rng, 2)))}-{d(rng, 2)}-{d(rng, 4)}", lambda: f"{d(rng, 3)}-00-{d(rng, 4)}", lambda: f"{_name(rng)} at {_name(rng)}.{_name(rng).capitalize()}",
        lambda: f"{_name(rng)} at {_name(rng)}.{rng.randint(1, 9)}", lambda: f"{_name(rng)}::{_name(rng)}", lambda: f"{rng.randint(0, 23):02d}:{d(rng, 2)}:{d(rng, 2)}", lambda: f"{d(rng, 2)}.{d(rng, 5)} {d(rng, 2)}.{d(rng, 5)}",
        lambda: " ".join(d(rng, rng.randint(1, 5)) for _ in range(rng.randint(3, 8))), lambda: f"{d(rng, 6)}-{d(rng, 6)}", lambda: f"{d(rng, 5)}/{d(rng, 5)}", lambda: f"{d(rng, 4)}-{d(rng, 4)}-{d(rng, 4)}",
        lambda: f"abc::{d(rng, 2)}", lambda: f"{d(rng, 3)}, {d(rng, 3)}.{d(rng, 2)} {d(rng, 4)}",
    )
    return rng.choice(("", "", rng.choice(OTHER) + rng.choice((": ", " ")), rng.choice(PERSONAL) + " ")), rng.choice(made)(), False


def taught(context: str, rng: random.Random) -> list[tuple[list[float], int]]:
    """(features, label) of the candidates that an example, written into the middle of a context, gives rise to.

    Only a candidate that is the whole of an example of personal data has label 1; its parts and extensions have 0.
    """
    cue, said, personal = example(rng)
    middle = context.rfind(" ", 0, len(context) // 2 + 1) + 1
    start = middle + len(cue)
    ends = (" ", " ", ". ", ", ", f" {_card(rng)} ", f", {_digits(rng, rng.randint(1, 8))} ")
    text = context[:middle] + cue + said + rng.choice(ends) + context[middle:]
    out = []
    for span in proposals(text):
        if span[0] < start + len(said) and span[1] > start:
            out.append((features(text, span), int(personal and span[:2] == (start, start + len(said)))))
    return out


def apart(spans: list[Span]) -> tuple[list[int], list[int]]:
    """Starts and, from the left, the greatest ends of spans that are sorted by start: for finding overlaps."""
    starts, ends, most = [], [], 0
    for s in spans:
        most = max(most, s[1])
        starts.append(s[0])
        ends.append(most)
    return starts, ends


def covered(span: Span, starts: list[int], ends: list[int]) -> bool:
    """Whether any of those spans overlaps this one."""
    i = bisect_right(starts, span[1] - 1)
    return i > 0 and ends[i - 1] > span[0]
