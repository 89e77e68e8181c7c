"""Pseudonyms in plain Python, value by value: what the column expressions must give.

Forms and ranges are taken from the operator (they say what counts as personal data); finding,
validating, permuting and writing are done anew.
"""

import hashlib
import re
from datetime import date, timedelta

from pagemill.llm import pii


def matcher(pattern):
    return re.compile(pattern, re.ASCII)


PATTERN = matcher(pii.PATTERN)
WHOLE = {
    name: matcher(f"^(?:{getattr(pii, name)})$")
    for name in ("EMAIL", "SECRET", "ACCESS_KEY", "SSN", "DATE", "ADDRESS", "PHONE", "FOREIGN_PHONE")
}
LENGTHS = {c: n for n, countries in pii.IBAN_LENGTHS.items() for c in countries.split()}


class Plain:
    def __init__(self, key):
        self.key = key

    def digest(self, *parts):
        return hashlib.sha256("|".join([self.key, *map(str, parts)]).encode()).hexdigest()

    def feistel(self, left, right, a, b, kind):
        for i in range(1, pii.ROUNDS + 1):
            if i % 2:
                left = (left + int(self.digest(kind, i, right)[:15], 16) % a) % a
            else:
                right = (right + int(self.digest(kind, i, left)[:15], 16) % b) % b
        return left, right

    def permuted(self, digits, kind):
        u = len(digits) // 2
        v = len(digits) - u
        left, right = self.feistel(int(digits[:u]), int(digits[u:]), 10**u, 10**v, kind)
        return f"{left:0{u}d}{right:0{v}d}"

    def text(self, text):
        if text is None:
            return None
        return PATTERN.sub(lambda m: self.value(m[0]), text)

    def value(self, m):
        form = lambda name: WHOLE[name].search(m)
        if "@" in m and form("EMAIL"):
            address = m.lower()
            domain = address.rpartition("@")[2]
            return f"u{self.digest('email', address)[:12]}@d{self.digest('domain', domain)[:8]}.example"
        if form("SECRET"):
            found = re.search(r"(?s)^([A-Za-z_-]+\s?[=:]\s?[\"']?)(.*)$", m, re.ASCII)
            return f"{found[1]}x{self.digest('secret', found[2])[:15]}"
        if form("ACCESS_KEY"):
            return "PSEU" + self.digest("access key", m)[:16].upper()
        for name, make in (("SSN", self.ssn), ("DATE", self.date), ("ADDRESS", self.address)):
            if form(name):
                return make(m)
        if form("PHONE") or form("FOREIGN_PHONE"):
            plan = m.startswith("+1") and len(digits_of(m)) == 11
            return self.foreign(m) if m.startswith("+") and not plan else self.phone(m)
        return self.numbers(m)

    def ssn(self, m):
        area, group, serial = map(int, m.split("-"))
        if not (1 <= area <= 899 and area != 666 and group and serial):
            return m
        areas = [x for x in range(1, 900) if x != 666]
        left, right = self.feistel(
            areas.index(area), (group - 1) * 9999 + serial - 1, len(areas), 99 * 9999, "ssn"
        )
        return f"{areas[left]:03d}-{right // 9999 + 1:02d}-{right % 9999 + 1:04d}"

    def date(self, m):
        sep = "-" if "-" in m else "/" if "/" in m else "."
        parts = m.split(sep)
        padded = all(len(p) >= 2 for p in parts)
        if len(parts[0]) == 4:
            orders = ["ymd"]
        elif sep == ".":
            orders = ["dmy"]
        else:
            orders = ["mdy", "dmy"]
        for order in orders:
            at = dict(zip(order, map(int, parts)))
            try:
                day = date(at["y"], at["m"], at["d"])
            except ValueError:
                continue
            first = date(1900, 1, 1)
            if not first <= day <= date(2099, 12, 31):
                continue
            n = (day - first).days
            left, right = self.feistel(n // 229, n % 229, 319, 229, "date")
            new = first + timedelta(days=left * 229 + right)
            write = {"y": f"{new.year:04d}"}
            for name, number in (("m", new.month), ("d", new.day)):
                write[name] = f"{number:02d}" if padded else str(number)
            return sep.join(write[x] for x in order)
        return m

    def address(self, m):
        a, b, c, d = map(int, m.split("."))
        if max(a, b, c, d) > 255:
            return m
        left, right = self.feistel(a * 256 + b, c * 256 + d, 65536, 65536, "address")
        return f"{left // 256}.{left % 256}.{right // 256}.{right % 256}"

    def phone(self, m):
        d = digits_of(m)
        prefix, local = d[:-10], d[-10:]
        area, exchange, line = int(local[:3]), int(local[3:6]), int(local[6:])
        if area < 200 or exchange < 200:
            return refilled(m, prefix + self.permuted(local, "other phone"))
        left, right = self.feistel(
            (area - 200) * 100 + line // 100, (exchange - 200) * 100 + line % 100, 80_000, 80_000, "phone"
        )
        return refilled(
            m, f"{prefix}{left // 100 + 200}{right // 100 + 200}{left % 100:02d}{right % 100:02d}"
        )

    def foreign(self, m):
        d = digits_of(m)
        code = re.search(pii.COUNTRY_CODE, "+" + d)
        if not (8 <= len(d) <= 15 and code):
            return m
        code = code[0][1:]
        return refilled(m, code + self.permuted(d[len(code) :], "foreign phone"))

    def numbers(self, m):
        groups = re.findall("[^ -]+[ -]?", m)
        ranks = []
        for i in range(len(groups)):
            tries = range(1, min(pii.MOST_GROUPS, len(groups) - i) + 1)
            ranks.append(max((rank(trimmed(groups[i : i + n])), n) for n in tries))
        out, i = "", 0
        while i < len(groups):
            kind, n = ranks[i]
            usual_inside = any(r == 2 for r, _ in ranks[i + 1 : i + n])
            if kind == 2 or (kind == 1 and not usual_inside):
                piece = trimmed(groups[i : i + n])
                out += self.iban(piece) if piece[0].isalpha() else self.card(piece)
                out += "".join(groups[i : i + n])[len(piece) :]
                i += n
            else:
                out += groups[i]
                i += 1
        return out

    def card(self, m):
        body = self.permuted(digits_of(m)[:-1], "card")
        check = next(c for c in "0123456789" if luhn(body + c))
        return refilled(m, body + check)

    def iban(self, m):
        plain = m.replace(" ", "")
        body = plain[4:]
        d = digits_of(body)
        body = refilled(body, self.permuted(d, "iban") if len(d) > 1 else d)
        check = 98 - as_number(body + plain[:2] + "00") % 97
        return refilled(m, f"{check:02d}" + digits_of(body))


def digits_of(m):
    return re.sub("[^0-9]", "", m)


def refilled(m, digits):
    rest = iter(digits)
    return re.sub("[0-9]", lambda _: next(rest), m)


def luhn(digits):
    values = [int(c) for c in reversed(digits)]
    return sum(v if i % 2 == 0 else sum(divmod(2 * v, 10)) for i, v in enumerate(values)) % 10 == 0


def as_number(text):
    return int("".join(str(int(c, 36)) for c in text))


def trimmed(groups):
    return re.sub("[ -]$", "", "".join(groups))


def rank(piece):
    plain = piece.replace(" ", "")
    if re.search("^[A-Z]{2}[0-9]{2}(?:[ ]?[A-Z0-9]){11,30}$", piece):
        if LENGTHS.get(plain[:2], len(plain)) == len(plain) and as_number(plain[4:] + plain[:4]) % 97 == 1:
            return 2
    d = digits_of(piece)
    if re.search("^[0-9 -]+$", piece) and 13 <= len(d) <= 19 and set(d) != {"0"} and luhn(d):
        return 2 if re.search(pii.CARD_LAYOUT, piece) else 1
    return 0
