"""Plain versions of the operators, for comparison on small inputs."""

import hashlib
import re

import xxhash

BASE = (
    ("assign", re.compile(r"""(?:[pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""), 1, 8),
    ("access", re.compile(r"AKIA[A-Z0-9]+"), 0, 16),
    ("hex", re.compile(r"[0-9a-f]+"), 0, 32),
)


def base_spans(text):
    out = []
    for order, (kind, pattern, group, least) in enumerate(BASE):
        out += [(m.start(), order, kind, m.end()) for m in pattern.finditer(text or "") if len(m[group]) >= least]
    return sorted(out)


def base_sha(text):
    return hashlib.sha256(",".join(f"{k}:{s}:{e}" for s, _, k, e in base_spans(text)).encode()).hexdigest()


def kept_bytes(rows, length=50):
    """rows: (doc_id, text); by place: (kept bytes, removed, spans)."""
    first = {}
    raws = [(doc_id if doc_id is not None else float("inf"), (text or "").encode()) for doc_id, text in rows]
    for doc_id, raw in raws:
        for i in range(len(raw) - length + 1):
            w = raw[i : i + length]
            first[w] = min(first.get(w, doc_id), doc_id)
    out = []
    for doc_id, raw in raws:
        gone = bytearray(len(raw))
        for i in range(len(raw) - length + 1):
            if first[raw[i : i + length]] < doc_id:
                gone[i : i + length] = b"\1" * length
        spans = sum(1 for i, g in enumerate(gone) if g and (i == 0 or not gone[i - 1]))
        out.append((bytes(b for b, g in zip(raw, gone, strict=True) if not g), sum(gone), spans))
    return out


ASSIGNED = r"""["']? *[:=] *["']?"""
WEAK = (
    ("ident", re.compile(r"(?i:\b(?:client|account|tenant|access_?key|user)[_-]?id)" + ASSIGNED + r"[A-Za-z0-9_.@-]{4,}")),
    ("secret", re.compile(r"[A-Za-z0-9+/=_-]+")),
    ("endpoint", re.compile(r"""https?://[^\s"'<>]+|(?<![A-Za-z0-9_.-])[a-z0-9.-]+:[0-9]+""")),
)


def _is_weak(kind, found, text, end):
    if kind == "secret":
        return len(found) == 40 and not set("=_-") & set(found) and all(re.search(c, found) for c in ("[a-z]", "[A-Z]", "[0-9]"))
    if kind == "endpoint" and not found.startswith("http"):
        host, _, port = found.rpartition(":")
        return 2 <= len(port) <= 5 and not re.match(r"\w", text[end:]) and host[-1].isalnum() and host[0] != "." and "." in host
    return True


def linked_spans(text, scope=256):
    """Base spans and those weak ones that have their complements within the scope, by comparing all pairs."""
    base = [(s, k, e) for s, _, k, e in base_spans(text)]
    weak = [(m.start(), kind, m.end()) for kind, p in WEAK for m in p.finditer(text) if _is_weak(kind, m[0], text, m.end())]
    near = lambda a, kinds: any(b[1] in kinds and a[0] - scope < b[2] and b[0] < a[2] + scope for b in base + weak if b != a)
    ident, secret = ("access", "ident"), ("assign", "hex", "secret")
    kept = [w for w in weak if (w[1] == "ident" or near(w, ident)) and (w[1] == "secret" or near(w, secret))]
    order = ("assign", "access", "hex", "ident", "secret", "endpoint")
    return sorted(((s, order.index(k), e) for s, k, e in base + kept))


def sketch(text, words=5, fraction=0.25):
    """Sorted shingle hashes below the fraction; a shingle's hash is folded from its words' hashes."""
    own = [xxhash.xxh64_digest(w.encode(), 42)[::-1] for w in re.split("[\\x09-\\x0D ]+", (text or "").lower()) if w]
    out = set()
    for i in range(len(own) - words + 1) if len(own) >= words else range(bool(own)):
        h = 42
        for w in own[i : i + words]:
            h = xxhash.xxh64_intdigest(w, h)
        if h < int(fraction * 2**64):
            out.add(h)
    return sorted(out)


def likeness(a, b, equal):
    a, b = set(a), set(b)
    return len(a & b) / len(a | b) if a | b else float(equal)
