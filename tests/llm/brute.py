"""Plain versions of the contracts, one document at a time, for small tables."""

import hashlib
import re
from collections import Counter

import xxhash

SMALL = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
WORD = re.compile(r"[^\x20\x09-\x0D]+")
ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def fingerprint(text):
    ws = WORD.findall((text or "").translate(SMALL))
    sh = [" ".join(ws[i : i + 3]) for i in range(len(ws) - 2)] if len(ws) >= 3 else [" ".join(ws)] * bool(ws)
    hs = [xxhash.xxh64_intdigest(s.encode(), 42) for s in sh]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def components(rows):
    """rows: (doc_id, fp); gives doc_id's smallest id by a search over all pairs."""
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            if (rows[i][1] ^ rows[j][1]).bit_count() <= 3:
                parent[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[find(i)] = min(d, least.get(find(i), d))
    return [least.get(find(i)) for i in range(len(rows))]


def contamination(text, items):
    ws = ALNUM.findall((text or "").translate(SMALL))
    hit, of = set(), set()
    where = {}
    for i, w in enumerate(ws):
        where.setdefault(w, []).append(i)
    for item, t in items:
        iw = ALNUM.findall((t or "").translate(SMALL))
        for k in range(max(1, len(iw) - 9)) if iw else ():
            win = iw[k : k + 10]
            for i in where.get(win[0], ()):
                if ws[i : i + len(win)] == win:
                    hit.update(range(i, i + len(win)))
                    of.add(str(item))
    return len(ws), len(hit), len(of), hashlib.sha256(",".join(sorted(of)).encode()).hexdigest(), bool(hit)


def luhn(ds):
    return sum(sum(divmod(int(c) * (1 + k % 2), 10)) for k, c in enumerate(reversed(ds))) % 10 == 0


def pii(text):
    text, out = text or "", []
    for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text):
        out.append(("email", *m.span()))
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(x) <= 255 for x in m.group().split(".")):
            out.append(("ip", *m.span()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        ds = re.sub("[^0-9]", "", m.group())
        if 13 <= len(ds) <= 19 and luhn(ds):
            out.append(("card", *m.span()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 9 <= len(re.sub("[^0-9]", "", m.group())) <= 15:
            out.append(("phone", *m.span()))
    return out


def secrets(text):
    text, out = text or "", []
    for m in re.finditer(r"((?a:(?i:password|passwd|secret|token|api_?key)))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", text):
        if len(m[2]) >= 6 and m[1].isascii():
            out.append((m.start(), 0, "assign", m.end()))
    out += [(m.start(), 1, "access", m.end()) for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m.group()) >= 20]
    out += [(m.start(), 2, "hex", m.end()) for m in re.finditer(r"[0-9a-f]+", text) if len(m.group()) >= 24]
    return [(k, a, b) for a, _, k, b in sorted(out)]


def sha(spans):
    return hashlib.sha256(",".join(f"{k}:{a}:{b}" for k, a, b in spans).encode()).hexdigest()


def quality(text):
    text = text or ""
    ws = WORD.findall(text)
    wins = [tuple(ws[i : i + 8]) for i in range(len(ws) - 7)]
    seen = Counter(wins)
    rep = {j for i, w in enumerate(wins) if seen[w] > 1 for j in range(i, i + 8)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return (len(ws), sum(map(len, ws)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(rep), len(ws) < 20 or 100 * len(rep) > 30 * len(ws))
