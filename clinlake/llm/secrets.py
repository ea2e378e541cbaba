"""Secret scan: candidate strings, and a random forest that removes false positives.

Candidates are runs of at least SHORTEST characters of keys, tokens and hashes that no letter touches, and
values of at least SHORTEST_VALUE printable characters that are assigned to names of passwords, secrets and
tokens: up to the closing quote, or to white space or the next parameter if they have no quotes; and passwords between the
user and the host of an address. The forest sees a
candidate's length, shares of character kinds and transitions between them, how much of it is covered by
dictionaries (the four-letter pieces of the rest of its text, those of the whole table, and a few words of
identifiers), the path of the document (its source) and the words around it: names of secrets, of checksums, of public
keys, of encoded data, of trackers and of markup, and the part of an address that it stands in. It is trained in numpy on
labelled findings: those given, or synthetic ones drawn from a seed (keys, tokens, passwords and passphrases against checksums, public keys,
encoded images, ids in addresses, classes, long words, numbers, identifiers and placeholders).

The table's dictionary holds the pieces that stand in at least COMMON of all its texts, outside candidates, so that
no secret gets into it however often its text is repeated. There are 26**4 pieces, whatever the data: each task
counts them in one array, and the driver gets one sum a piece. Forests are trained with the dictionary of their findings.

Nulls: a null text has no candidates, and counts as a text without pieces; a null source has no path. Repeated rows
give repeated findings. Very long texts are counted in blocks. An empty table gives an empty result. Extra columns are left out.
"""

from __future__ import annotations

import hashlib
import re
import unicodedata
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clinlake.llm import common

SHORTEST, SHORTEST_VALUE = 16, 8
THRESHOLD = 0.5
FINDINGS = 8_000
TREES, DEPTH, LEAF = 40, 12, 3
#: Least share of texts that makes a piece a part of the table's dictionary, and the number of pieces there are.
COMMON, PIECES = 0.001, 26**4
#: Bytes on each side of a candidate whose words count as its neighbours.
AROUND = 32

_CANDIDATE = re.compile(rb"(?<![A-Za-z0-9+/_\-])([A-Za-z0-9+/_\-]{%d,})(?![A-Za-z0-9+/_\-])={0,2}" % SHORTEST)
_NAMES = r"pass(?:wd|word|phrase)?|pwd|secret|token|api.?key|auth|bearer|credential|private.?key|access.?key|密码|密碼|口令"
_HINT = re.compile(_NAMES.encode(), re.I)
#: Every name holds one of these, so that most texts need no search for assignments.
_STEMS = tuple(w.encode() for w in ("pass", "pwd", "secret", "token", "key", "auth", "bearer", "credential", "密码", "密碼", "口令"))
_SIGN, _OPEN = r"(?:[:=]>?|：|＝)", r"(?:[\"'`]|“|‘)"
_VALUE = re.compile(
    (
        rf"(?:{_NAMES})[A-Za-z0-9_.\-]{{0,40}}[\"'`\]]{{0,2}}[ \t]{{0,8}}{_SIGN}[ \t]{{0,8}}"
        r"(?:\"([^\"\x00-\x1f\x7f]+)\"|'([^'\x00-\x1f\x7f]+)'|`([^`\x00-\x1f\x7f]+)`|“((?:(?!”)[^\x00-\x1f\x7f])+)”|‘((?:(?!’)[^\x00-\x1f\x7f])+)’"
        # Without quotes, the next parameter of an address ends a value.
        rf"|(?!{_OPEN})((?:(?!&[A-Za-z_][\w.\-]*=)[^\x00-\x20\x7f])+))"
    ).encode(),
    re.I,
)
#: The password of an address: scheme, user, password, host.
_LOGIN = re.compile(rb"[A-Za-z][A-Za-z0-9+.\-]{1,20}://[^\x00-\x20:/@?#\x7f]{0,64}:([^\x00-\x20/@\x7f]{%d,256})@" % SHORTEST_VALUE)
_HARMLESS = re.compile(rb"example|sample|dummy|placeholder|your|xxxx|test|todo|changeme", re.I)
_DIGEST = re.compile(rb"sha-?\d*|md5|checksum|digest|commit|integrity|uuid|revision|etag|\bh\d:|blob|tree|parent|crc|hash|trace|request.?id", re.I)
_PUBLIC = re.compile(rb"ssh-(?:rsa|dss|ed25519)|ecdsa-sha2|certificate|public.?key|fingerprint|AAAA[BCE]3Nza|pubkey", re.I)
_DATA = re.compile(rb"base64|data:|image/|font/|application/", re.I)
_TRACKER = re.compile(rb"[?&;](?:utm_\w+|[a-z]*clid|ref|id|\w+_id|\w*[a-z]Id|v|cid|rev|hash|page|q|tag|doc|session|s|t|track\w*)=$", re.I)
_MARKUP = re.compile(rb"(?:class|className|id|for|style|href|src|d|aria-\w+)\s*=\s*[\"'{]?[^\"'<>]{0,60}$|[.#]$", re.I)
_GLUED = re.compile(rb"\S*$")
_ASSIGNED = re.compile(rf"{_SIGN}\s*{_OPEN}?$".encode())
_QUOTED = re.compile(f"{_OPEN}$".encode())
_DICTIONARY = (b"name", b"type", b"value", b"class", b"get", b"set", b"list", b"data", b"file", b"path", b"user", b"config", b"service", b"manager", b"factory", b"handler", b"test", b"index", b"model", b"error", b"http", b"html", b"image", b"version", b"abstract", b"default", b"request", b"response")
_CODE = re.compile(r"\.(?:env|ya?ml|json|ini|conf|cfg|toml|properties|py|js|ts|java|go|rb|sh|tf)$", re.I)
_TEST_PATH = re.compile(r"test|spec|fixture|example|sample|doc|mock", re.I)


def _letter_at(text: bytes, start: int, stop: int, first: bool) -> bool:
    """Whether the first or last character of a few bytes beside a run is a letter, digit or mark outside ASCII."""
    near = text[start:stop].decode("utf-8", "ignore")
    c = near[:1] if first else near[-1:]
    return c > "\x7f" and (c.isalnum() or unicodedata.category(c)[0] == "M")


def runs(text: bytes) -> list[tuple[int, int]]:
    out = []
    for m in _CANDIDATE.finditer(text):
        start, end = m.span(1)
        left = start > 0 and text[start - 1] > 127 and _letter_at(text, max(0, start - 4), start, False)
        right = end < len(text) and text[end] > 127 and _letter_at(text, end, end + 4, True)
        if not left and not right:
            out.append(m.span())
    return out


def values(text: bytes) -> list[tuple[int, int]]:
    """Values assigned to names of secrets; those without quotes lose closing punctuation."""
    low = text.lower()
    if not any(stem in low for stem in _STEMS):
        return []
    out = []
    for m in _VALUE.finditer(text):
        start, stop = m.span(m.lastindex)
        if m.lastindex == 6:
            stop = start + len(text[start:stop].rstrip(b",;)]}>\"'`"))
        if len(text[start:stop].decode("utf-8", "replace")) >= SHORTEST_VALUE:
            out.append((start, stop))
    return out


def logins(text: bytes) -> list[tuple[int, int]]:
    """Passwords in addresses."""
    return [m.span(1) for m in _LOGIN.finditer(text)] if b"://" in text else []


def candidates(text: bytes) -> list[tuple[int, int]]:
    """Start and stop of all candidates, in order; a span that is of several kinds counts once."""
    return sorted({*runs(text), *values(text), *logins(text)})


def _kind(c: int) -> int:
    return 0 if 48 <= c < 58 else 1 if 65 <= c < 91 else 2 if 97 <= c < 123 else 3


class Pieces:
    """How often each four-letter piece (a-z) stands in a text, for all its candidates."""

    def __init__(self, text: bytes):
        self.held = np.sort(_codes(text.lower()))

    def outside(self, text: bytes, start: int, stop: int) -> tuple[np.ndarray, np.ndarray]:
        """Places of the candidate's pieces in it, and which of them stand in the rest of the text too."""
        codes = _codes(text[start:stop].lower(), -1)
        at = np.flatnonzero(codes >= 0)
        wanted = codes[at]
        # Pieces that reach into the candidate are its own.
        own = np.sort(_codes(text[max(0, start - 3) : stop + 3].lower()))
        count = lambda held: np.searchsorted(held, wanted, "right") - np.searchsorted(held, wanted, "left")
        return at, count(self.held) > count(own)


def _codes(low: bytes, other: int | None = None) -> np.ndarray:
    """The pieces of a lower-cased text as numbers; those with other bytes are left out, or given as `other`."""
    c = np.frombuffer(low, np.uint8).astype(np.int32) - 97
    if len(c) < 4:
        return np.zeros(0, np.int32)
    letter = (c >= 0) & (c < 26)
    whole = letter[:-3] & letter[1:-2] & letter[2:-1] & letter[3:]
    codes = ((c[:-3] * 26 + c[1:-2]) * 26 + c[2:-1]) * 26 + c[3:]
    return codes[whole] if other is None else np.where(whole, codes, other)


class Counts:
    """In how many texts each piece stands outside candidates."""

    def __init__(self):
        self.texts, self.held, self.last = 0, np.zeros(PIECES, np.int64), np.full(PIECES, -1, np.int64)

    def add(self, text: bytes) -> None:
        me, at = self.texts, 0
        self.texts += 1
        # Candidates part what is beside them; those that overlap part it once.
        for start, stop in [*candidates(text), (len(text), len(text))]:
            for low in range(at, start, common.PIECE):
                found = np.unique(_codes(text[low : min(start, low + common.PIECE + 3)].lower()))
                found = found[self.last[found] != me]
                self.last[found] = me
                self.held[found] += 1
            at = max(at, stop)


def common_pieces(held: np.ndarray, texts: int) -> np.ndarray:
    """The dictionary as one flag a piece, from the numbers of texts that hold them."""
    return (held > 0) & (held >= COMMON * texts)


def dictionary(docs: DataFrame) -> np.ndarray:
    """The dictionary of a table, counted over the whole texts of all its rows."""
    common.tune(docs.sparkSession)

    def run(batches):
        counts = Counts()
        for batch in batches:
            for text in common.byte_rows(batch.column(0)):
                counts.add(text)
        at = np.flatnonzero(counts.held)
        # The number of texts goes along as the piece -1.
        for piece, n in ((np.array([-1]), np.array([counts.texts])), (at, counts.held[at])):
            yield pa.record_batch([pa.array(piece, pa.int32()), pa.array(n, pa.int64())], names=["piece", "n"])

    rows = docs.select(F.col("text").cast("string").alias("text")).mapInArrow(run, "piece int, n bigint")
    sums = rows.groupBy("piece").agg(F.sum("n").alias("n")).toArrow()
    held = np.zeros(PIECES + 1, np.int64)
    held[sums.column("piece").to_numpy()] = sums.column("n").to_numpy()
    return common_pieces(held[:-1], int(held[-1]))


def coverage(value: bytes, text: bytes, start: int, stop: int, pieces: Pieces | None = None, known: np.ndarray | None = None) -> tuple[float, float, float]:
    """Shares of the candidate covered by four-letter pieces of the rest of the text, by words of identifiers, and by
    pieces of a dictionary; without one, the rest of the text is the dictionary."""
    low = value.lower()
    hit, common_hit = np.zeros(len(low), bool), np.zeros(len(low), bool)
    at, found = (pieces or Pieces(text)).outside(text, start, stop)
    for i in at[found]:
        hit[i : i + 4] = True
    for i in at[found] if known is None else at[known[_codes(low, 0)[at]]]:
        common_hit[i : i + 4] = True
    word = np.zeros(len(low), bool)
    for w in _DICTIONARY:
        at = low.find(w)
        while at >= 0:
            word[at : at + len(w)] = True
            at = low.find(w, at + 1)
    return float(hit.mean()), float(word.mean()), float(common_hit.mean())


def describe(text: bytes, start: int, stop: int, path: str | None, pieces: Pieces | None = None, known: np.ndarray | None = None) -> list[float]:
    value = text[start:stop]
    n = len(value)
    kinds = [_kind(c) for c in value]
    share = [kinds.count(k) / n for k in range(4)]
    steps = sum(a != b for a, b in zip(kinds, kinds[1:])) / max(1, n - 1)
    count = np.array(list(Counter(value).values())) / n
    before, after = text[max(0, start - AROUND) : start], text[stop : stop + AROUND]
    hexes = sum(c in b"0123456789abcdefABCDEF" for c in value) / n
    # What stands before it without a space says which part of an address it is.
    glued = _GLUED.search(text[max(0, start - 300) : start])[0]
    address = b"://" in glued or glued.startswith(b"www.")
    return [
        float(min(n, 200)), *share, steps, float(-(count * np.log2(count)).sum()), float(count.max()), hexes,
        float(n in (32, 40, 64, 96, 128)), *coverage(value, text, start, stop, pieces, known),
        float(bool(path and _CODE.search(path))), float(bool(path and _TEST_PATH.search(path))),
        float(bool(_HINT.search(before))), float(bool(_ASSIGNED.search(before))), float(bool(_QUOTED.search(before))),
        float(bool(_DIGEST.search(before))), float(bool(_HARMLESS.search(before + value + after))), float(bool(re.match(rb"[A-Z]{3,5}[A-Z0-9]{12,}$|gh[pousr]_|sk[-_]|xox[abp]-|eyJ|AIza|npm_|glpat-|[rp]k_", value))),
        float(bool(_PUBLIC.search(before + value[:12]))), float(bool(_DATA.search(before))), float(bool(re.match(rb"sha\d+-", value))), float(address), float(address and b"?" in glued), float(address and text[stop : stop + 1] == b"@"),
        float(bool(_TRACKER.search(glued))), float(bool(_MARKUP.search(before))), float(bool(_HINT.search(glued))), float(value.count(b"-")), float(value.count(b"_")), float(value.count(b"/")), float(value.count(b".")), float(after[:1] in (b"(", b"[")),
    ]


@dataclass
class Tree:
    feature: np.ndarray
    cut: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray

    def predict(self, x: np.ndarray) -> np.ndarray:
        at = np.zeros(len(x), np.int64)
        while True:
            f = self.feature[at]
            inner = f >= 0
            if not inner.any():
                return self.value[at]
            go = x[np.arange(len(x)), np.maximum(f, 0)] <= self.cut[at]
            at = np.where(inner, np.where(go, self.left[at], self.right[at]), at)


def grow(x: np.ndarray, y: np.ndarray, rng: np.random.Generator, depth: int = DEPTH, leaf: int = LEAF) -> Tree:
    """A tree by Gini impurity over a random choice of features at every node."""
    nodes: list[list] = []
    tries = max(2, int(np.sqrt(x.shape[1])) + 1)

    def build(rows: np.ndarray, level: int) -> int:
        me = len(nodes)
        nodes.append([-1, 0.0, 0, 0, float(y[rows].mean())])
        if level == depth or len(rows) < 2 * leaf or y[rows].min() == y[rows].max():
            return me
        best = None
        for f in rng.choice(x.shape[1], tries, replace=False):
            order = rows[np.argsort(x[rows, f], kind="stable")]
            v, ones = x[order, f], np.cumsum(y[order])
            n = np.arange(1, len(order))
            ok = (v[1:] != v[:-1]) & (n >= leaf) & (len(order) - n >= leaf)
            if not ok.any():
                continue
            p, q = ones[:-1] / n, (ones[-1] - ones[:-1]) / (len(order) - n)
            gini = np.where(ok, n * p * (1 - p) + (len(order) - n) * q * (1 - q), np.inf)
            k = int(gini.argmin())
            if best is None or gini[k] < best[0]:
                best = (gini[k], int(f), (v[k] + v[k + 1]) / 2)
        if best is None:
            return me
        go = x[rows, best[1]] <= best[2]
        nodes[me][:2] = best[1:]
        nodes[me][2] = build(rows[go], level + 1)
        nodes[me][3] = build(rows[~go], level + 1)
        return me

    build(np.arange(len(x)), 0)
    f, c, left, right, value = zip(*nodes)
    return Tree(np.array(f), np.array(c), np.array(left), np.array(right), np.array(value))


class Forest:
    def __init__(self, trees: int = TREES, seed: int = 0):
        self.count, self.seed, self.trees = trees, seed, []

    def fit(self, x: np.ndarray, y: np.ndarray) -> Forest:
        rng = np.random.default_rng(self.seed)
        for _ in range(self.count):
            rows = rng.integers(0, len(x), len(x))
            self.trees.append(grow(x[rows], y[rows], rng))
        return self

    def score(self, x: np.ndarray) -> np.ndarray:
        return np.mean([t.predict(x) for t in self.trees], axis=0) if len(x) else np.zeros(0)


def labelled_findings(n: int = FINDINGS, seed: int = 0) -> list[tuple[bytes, int, int, str, int]]:
    """Synthetic (text, start, stop, path, label): half secrets, half strings that look like them."""
    rng = np.random.default_rng(seed)
    pick = lambda items: items[int(rng.integers(len(items)))]
    draw = lambda letters, k: "".join(letters[i] for i in rng.integers(len(letters), size=k))
    some = lambda a, b: int(rng.integers(a, b))
    low, up, num, hexes = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789", "0123456789abcdef"
    both = low + up + num
    b64 = both + "+/"
    # Syllables of an invented language, so that the forest learns no vocabulary.
    syllables: list[str] = []
    word = lambda k: "".join(pick(syllables) for _ in range(k))
    words = lambda k, by, size=2: by.join(word(size) for _ in range(k))
    # Chosen passwords mix kinds of characters; plain values are words, references and calls.
    chosen = lambda k: word(1).capitalize()[: k - 4] + draw(both + "!#$%*.?^~", max(k - 4, 4)) + draw(num, 1) + draw("!#$%*.?^~", 1)
    named = lambda: pick(["password=", "token = \"", "secret: ", "api_key=", "auth_token='", "Authorization: Bearer ", "passwd = ", "token = “", "密码：", "\"client_secret\": \"", "export DB_PASSWORD=", "access_key = ", "apiKey: '", "X-Auth-Token: ", "_authToken="])
    weak = lambda: pick(["password=", "token = ", "secret: ", "password = \"", "token: ", "密码：", "api_key = ", "auth: "])
    host = lambda: f"{word(2)}.{pick(['com', 'org', 'io', 'net'])}"
    secret = [
        lambda: (pick(["", named()]), "AKIA" + draw(up + num, 16)), lambda: (named(), draw(hexes, pick([18, 20, 24, 32, 40, 64]))), lambda: (named(), draw(both, some(20, 60))),
        lambda: (named(), draw(b64, pick([40, 64, 86, 88])) + pick(["", "=", "=="])), lambda: (pick(["", named()]), pick(["ghp_", "gho_", "npm_"]) + draw(both, 36)), lambda: (named(), draw(both + "_-", some(16, 44))),
        lambda: (named(), chosen(some(8, 24))), lambda: (pick(["passphrase: ", "password: ", "pass_phrase=", "password = \"", "pwd: "]), words(some(4, 7), "-", 1) if rng.random() < 0.5 else words(some(4, 6), "-")),
        lambda: (f"{pick(['postgres', 'mysql', 'amqp', 'redis', 'https', 'mongodb+srv'])}://{word(2)}:", pick([chosen(some(8, 18)).replace("?", "x").replace("#", "y"), draw(both, some(8, 24))]), f"@{host()}/{word(1)}"),
        lambda: (f"?{word(1)}=1&{pick(['token', 'api_key', 'access_token', 'password'])}=", draw(both, some(16, 40)), f"&{word(1)}={word(1)}"), lambda: (pick(["key ", "maps ", named()]), "AIza" + draw(both + "_-", 35)),
        lambda: (pick(["", named()]), f"{pick(['xoxb', 'xoxp'])}-{draw(num, 12)}-{draw(num, 12)}-{draw(both, 24)}"), lambda: (pick(["", named()]), pick(["sk_live_", "rk_live_", "sk-", "glpat-"]) + draw(both, some(20, 40))),
        lambda: (pick(["Bearer ", "jwt ", named()]), f"eyJ{draw(both, some(20, 40))}"), lambda: (f"-----BEGIN {pick(['RSA ', 'EC ', ''])}PRIVATE KEY-----\n", draw(b64, 64), "\n"), lambda: ("Authorization: Basic ", draw(b64, some(20, 44)) + pick(["", "="])),
        lambda: (pick(["AccountKey=", "SharedAccessKey=", "aws_secret_access_key = "]), draw(b64, pick([40, 43, 86])) + pick(["", "=", "=="]), ";"),
    ]
    plain = [lambda: word(4), lambda: word(2) + "." + word(2), lambda: f"{word(2)}.{word(2)}()", lambda: "${" + word(3).upper() + "}", lambda: f"<{word(3)}>", lambda: f"{word(2)} {word(2)} {word(1)}", lambda: word(2) + "_" + word(2), lambda: f"get{word(2).capitalize()}{word(2).capitalize()}()", lambda: words(3, "_"), lambda: f"os.environ['{word(3).upper()}']"]
    uuid = lambda: f"{draw(hexes, 8)}-{draw(hexes, 4)}-4{draw(hexes, 3)}-a{draw(hexes, 3)}-{draw(hexes, 12)}"
    other = [
        lambda: ("", word(some(6, 10))), lambda: ("", word(7).upper()), lambda: ("", draw(num, pick([16, 16, 18, 20]))), lambda: (pick(["", "uuid ", "id: "]), uuid()), lambda: ("", "get" + "".join(word(2).capitalize() for _ in range(4)), pick(["(", " "])),
        lambda: ("", words(4, "_")), lambda: ("", words(4, "/")), lambda: (pick(["token = \"", "password=", ""]), "x" * some(16, 40)), lambda: (pick(["token = \"", "api_key="]), "your_api_key_" + word(3)), lambda: (weak(), pick(plain)()), lambda: (weak(), pick(plain)()),
        lambda: (pick(["sha256: ", "commit ", "md5=", "checksum: ", "blob ", "etag: \"", "@sha256:", "tree "]), draw(hexes, pick([32, 40, 64]))), lambda: ("", "-" * some(16, 60)), lambda: (pick(["", "const "]), words(4, "_").upper()),
        lambda: (pick(["integrity=\"", "\"integrity\": \"", "integrity "]), f"{pick(['sha512', 'sha384', 'sha256', 'sha1'])}-{draw(b64, pick([43, 64, 86]))}" + pick(["", "=", "=="])), lambda: (f"{host()}/{word(2)} v{draw(num, 1)}.{draw(num, 2)}.0 h1:", draw(b64, 43) + "="),
        lambda: (pick(["data:image/png;base64,", "url(data:font/woff2;base64,", "src=\"data:image/gif;base64,"]), draw(b64, some(40, 200)) + pick(["", "=", "=="])), lambda: (pick(["ssh-rsa ", "ssh-ed25519 ", "ecdsa-sha2-nistp256 "]), pick(["AAAAB3NzaC1yc2E", "AAAAC3NzaC1lZDI1NTE5AAAAI", "AAAAE2VjZHNhLXNoYTItbmlzdHAyNTYA"]) + draw(b64, some(40, 200)), f" {word(2)}@{host()}"),
        lambda: (pick(["-----BEGIN CERTIFICATE-----\n", "-----BEGIN PUBLIC KEY-----\n", "public_key: ", "fingerprint SHA256:"]), draw(b64, pick([43, 64]))), lambda: (f"https://{host()}/{word(1)}/", draw(both + "_-", some(16, 44)), pick(["/", " ", f"/{word(1)}"])),
        lambda: (f"https://{host()}/{word(2)}/{pick(['d/', 'watch/', 'id/', 'file/'])}", draw(both + "_-", some(20, 44)) + pick(["", "/edit", "/view"])),
        lambda: (f"https://{host()}/{word(1)}?{pick(['utm_id', 'utm_source', 'gclid', 'fbclid', 'ref', 'id', 'cid', 'v', 'rev', 'doc_id', 'itemId', 'page'])}=", draw(both + "_-", some(16, 60)), pick([" ", f"&{word(1)}={word(1)}"])),
        lambda: (f"https://{host()}/?{word(1)}={word(1)}&{pick(['utm_campaign', 'msclkid', 'session', 'hash', 'q', 'tag'])}=", draw(both, some(16, 40))), lambda: (pick(["class=\"", "className=\"", "<div class='", "class=\"" + word(2) + " "]), f"{word(2).capitalize()}_{word(1)}__{draw(both, some(5, 12))}" if rng.random() < 0.5 else words(some(3, 6), "-")),
        lambda: (pick(["class=\"", "id=\"", "."]), f"{pick(['css', 'sc', 'jss', word(1)])}-{draw(both, some(12, 24))}"), lambda: (pick(["href=\"#", "id=\"", "for=\""]), words(some(3, 6), "-")), lambda: (f"{word(1)}/static/{word(1)}.", draw(hexes, pick([16, 20, 32])), ".js"),
        lambda: (pick(["X-Request-Id: ", "trace_id=", "traceparent: 00-", "correlation id "]), draw(hexes, 32)), lambda: (f"<path d=\"", f"M{draw(num, 2)}-{draw(num, 3)}-{draw(num, 3)}-{draw(num, 4)}-{draw(num, 3)}"), lambda: (pick(["at ", "id ", "ts="]), "2024" + draw(num, some(12, 16))),
        lambda: (pick(["pip install ", "import ", "docker pull "]), words(some(2, 4), "-") + "-" + words(2, "/")),
    ]
    out = []
    for i in range(n):
        syllables[:] = [draw("bcdfghklmnprstvz", 1) + draw("aeiou", 1) + draw("lmnrst", some(0, 2)) for _ in range(30)]
        label = i % 2
        kinds = secret if label else other
        lead, value, *tail = kinds[(i // 2) % len(kinds)]()
        if len(value) < SHORTEST_VALUE:
            value += draw(low, SHORTEST) if label else word(6)
        sentence = lambda: " ".join(word(some(1, 4)) for _ in range(some(8, 60)))
        head = f"{sentence()} {lead}".encode()
        close = tail[0] if tail else {"'": "'", '"': '"', "“": "”"}.get(lead[-1:], "") + " "
        path = pick(["src/app.py", "deploy/prod.env", "conf/site.yaml", "tests/fixtures/a.json", "docs/readme.md", "notes.txt", ""])
        out.append((head + value.encode() + (close + sentence()).encode(), len(head), len(head) + len(value.encode()), path, label))
    return out


def train(findings: list[tuple[bytes, int, int, str, int]] | None = None, seed: int = 0) -> Forest:
    """A forest fitted on labelled findings (text, start, stop, path, label)."""
    rows = labelled_findings(seed=seed) if findings is None else findings
    counts = Counts()
    for text, *_ in rows:
        counts.add(text)
    known = common_pieces(counts.held, counts.texts)
    x = np.array([describe(t, a, b, p, known=known) for t, a, b, p, _ in rows])
    return Forest(seed=seed).fit(x, np.array([y for *_, y in rows], float))


FOUND = "doc_id bigint, start int, stop int, value_sha256 string, score double, is_secret boolean"


def scan(docs: DataFrame, forest: Forest | None = None, threshold: float = THRESHOLD, known: np.ndarray | None = None) -> DataFrame:
    """Every candidate of every text: doc_id, start and stop in code points, a digest of the string, its score and verdict.
    known: a dictionary that was counted before, in place of the one of docs."""
    common.tune(docs.sparkSession)
    known = dictionary(docs) if known is None else known
    # The size of a forest is fixed by TREES and DEPTH, that of a dictionary by PIECES.
    shared = docs.sparkSession.sparkContext.broadcast((forest or train(), known))

    def run(batches):
        forest, known = shared.value
        for batch in batches:
            who, where, digest, rows = [], [], [], []
            for doc_id, text, path in zip(batch.column(0).to_pylist(), common.byte_rows(batch.column(1)), batch.column(2).to_pylist()):
                at = chars = 0
                spans = candidates(text)
                pieces = Pieces(text) if spans else None
                for start, stop in spans:
                    chars += len(text[at:start].decode("utf-8", "replace"))
                    at = start
                    who.append(doc_id)
                    where.append((chars, chars + len(text[start:stop].decode("utf-8", "replace"))))
                    digest.append(hashlib.sha256(text[start:stop]).hexdigest())
                    rows.append(describe(text, start, stop, path, pieces, known))
            score = forest.score(np.array(rows))
            start, stop = zip(*where) if where else ((), ())
            yield pa.record_batch([pa.array(who, pa.int64()), pa.array(start, pa.int32()), pa.array(stop, pa.int32()), pa.array(digest, pa.string()), pa.array(score, pa.float64()), pa.array(score >= threshold, pa.bool_())], names=["doc_id", "start", "stop", "value_sha256", "score", "is_secret"])

    path = F.col("source").cast("string") if "source" in docs.columns else F.lit(None).cast("string")
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"), path.alias("source")).mapInArrow(run, FOUND)


def query(spark, sf_dir: str) -> DataFrame:
    return scan(common.read(spark, sf_dir, "documents").select("doc_id", "text", "source"))
