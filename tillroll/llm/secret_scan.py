"""Secret scan: fixed patterns plus zstandard novelty in sensitive contexts.

The fixed patterns find assignments, access keys and long hexadecimal runs.
Further candidates are long mixed strings close behind a sensitive word.  A
candidate's novelty is the number of bytes it adds to a zstandard frame whose
dictionary holds code identifiers and the surrounding text, with the candidate
itself blanked out: names, paths and repeated phrases cost a few bytes, a random
string costs what its alphabet needs, about its own length if it is short.
Candidates that cost about as much as a random string of their length and
alphabet are reported.
"""

from __future__ import annotations

import hashlib
import random
import re
import string
from functools import lru_cache
from typing import Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tillroll.llm._shared import map_arrow

KINDS = ("assign", "access", "hex", "novel")
# fixed values of the contract
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
                    re.I | re.A)
ASSIGN_WORDS = ("passw", "secret", "token", "key")
ASSIGN_LEAST = 12
ACCESS = re.compile(r"AKIA[A-Z0-9]{14,}")     # 18 or more characters
HEX = re.compile(r"[0-9a-f]{16,}")

#: A sensitive word, alone or at a border within a longer name, and the value on its line or, behind : or =, on the next.
SENSITIVE = re.compile(r"(?:pass(?:word|wd|phrase)?|secret|token|api[_-]?key|auth(?:orization)?|bearer|credentials?"
                       r"|private[_-]?key|access[_-]?key|signature|client[_-]?id)(?:key|token|value|code|id|hash)?s?"
                       r"(?:\b|(?=[_0-9])|(?-i:(?<=[a-z])(?=[A-Z])))(?:[^\n]{0,48}|[^\n:=]{0,32}[:=][^\nA-Za-z0-9]{0,8}\n"
                       r"[^\nA-Za-z0-9]{0,32})$", re.I | re.A)
SENSITIVE_HINTS = ("pass", "secret", "token", "key", "auth", "bearer", "credential", "signature", "client")
CANDIDATE = re.compile(r"[A-Za-z0-9+/_-]{16,}={0,2}")     # a name before = is context
#: Words that code around credentials uses; they prime the dictionary before the context does.
IDENTIFIERS = " ".join("""
access account address api_key apikey application args authorization auth_token aws_access_key_id
aws_secret_access_key base64 basic bearer begin bool bucket build cache callback cert certificate class client
client_id client_secret config configuration connection const content context cookie create credential credentials
data database default delete description development email enable endpoint environment error example export false
file final format from function github google hash header headers host http https import index init input instance
integer interface java json key language length license list local localhost login main message method module name
namespace none null number object option output package parameter parent password path payload port postgres prefix
private private_key production property protected public query redis refresh_token region register release request
response return role root schema script secret secret_key self server service session signature source ssh-rsa
static status string system table target template test text this timeout title token true type undefined update
upload uri url user user_id username uuid value variable version void windows www.example.com mail.example.org
abcdefghijklmnopqrstuvwxyz ABCDEFGHIJKLMNOPQRSTUVWXYZ 0123456789 xxxxxxxxxxxxxxxxxxxxxxxxxxxxxxxx 0000000000000000
""".split())
LEAST = 0.85              # share of a random string's novel bytes from which a candidate is reported
ALPHABETS = tuple(sorted((string.digits + "ABCDEF", string.digits + "abcdef", string.ascii_uppercase + "234567",
                          string.hexdigits, string.digits + string.ascii_uppercase, string.digits + string.ascii_lowercase,
                          string.digits + string.ascii_letters, string.digits + string.ascii_letters + "+/",
                          string.digits + string.ascii_letters + "-_"), key=lambda a: len(set(a))))
LONGEST = 4096            # characters from which the cost of a random string per character is steady
CONTEXT = 2048            # code points of text on either side that prime the dictionary


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind index, end) of the fixed patterns' matches."""
    out = []
    low = text.lower()
    if any(w in low for w in ASSIGN_WORDS):
        out += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= ASSIGN_LEAST]
    if "AKIA" in text:
        out += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text)]
    out += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(out)


def novelty(candidate: str, before: str, after: str) -> float:
    """Bytes that ``candidate`` adds to a frame primed with identifiers and its context, per byte."""
    raw = candidate.encode()
    return _added(raw, "\n".join((IDENTIFIERS, after, before)).encode("utf-8", "surrogatepass"))


def _added(raw: bytes, prime: bytes) -> float:
    press = zstandard.ZstdCompressor(
        level=19, write_checksum=False, write_content_size=False,
        dict_data=zstandard.ZstdCompressionDict(prime, dict_type=zstandard.DICT_TYPE_RAWCONTENT))
    return (len(press.compress(raw)) - len(press.compress(b""))) / len(raw)


def randomness(candidate: str) -> float:
    """The novelty of a random string of the candidate's length and alphabet, 1 at most."""
    used = set(candidate.rstrip("="))
    alphabet = next((a for a in ALPHABETS if used <= set(a)), None)
    return 1.0 if alphabet is None else _random_novelty(alphabet, min(len(candidate), LONGEST))


@lru_cache(4096)
def _random_novelty(alphabet: str, n: int) -> float:
    r = random.Random(n)
    symbols = sorted(set(alphabet))
    return min(1.0, _added("".join(r.choices(symbols, k=n)).encode(), IDENTIFIERS.encode()))


def novel_spans(text: str, base: list[tuple[int, int, int]], least: float) -> list[tuple[int, int, int]]:
    """Candidates that no base span covers, that stand behind a sensitive word and compress no better than random ones."""
    low = text.lower()
    if not any(w in low for w in SENSITIVE_HINTS):
        return []
    out = []
    for m in CANDIDATE.finditer(text):
        a, b = m.span()
        s = m.group()
        # a secret mixes digits and letters; words of any language don't
        if not (any(map(str.isdigit, s)) and any(map(str.isalpha, s))):
            continue
        if any(x <= a and b <= y for x, _, y in base) or not SENSITIVE.search(text, max(0, a - 128), a):
            continue
        if novelty(s, text[max(0, a - CONTEXT):a], text[b:b + CONTEXT]) >= least * randomness(s):
            out.append((a, 3, b))
    return out


def secret_spans(text: str | None, least: float) -> list[tuple[int, int, int]]:
    if not text:
        return []
    base = base_spans(text)
    return sorted(base + novel_spans(text, base, least))


def said(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in spans)


def scan_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: float = LEAST,
                 redact: bool = False) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_assign, n_access, n_hex, n_novel, base_sha256, spans.

    ``spans`` lists kind:start:end in code points of the whole text (end
    exclusive), by start, then kind.  Null and empty texts have none; repeated
    rows give equal rows; other columns aren't read.  With ``redact`` the rows
    of ``docs`` come back instead, with all columns, each secret replaced
    (see ``redacted``)."""
    names = docs.columns
    if not redact:
        narrow = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
        return map_arrow(narrow, _scan(least), "doc_id long, n_assign long, n_access long, n_hex long, n_novel long, "
                                               "base_sha256 string, spans string")
    packed = docs.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("row"))
    out = map_arrow(packed, _redact(text_col, least), StructType([packed.schema["row"]]).add("clean", "string"))
    swap = {text_col: F.col("clean").alias(text_col)}
    if "n_chars" in names:
        swap["n_chars"] = (F.when(F.col("clean") == F.col(f"row.`{text_col}`"), F.col("row.n_chars"))
                           .otherwise(F.char_length("clean").cast(docs.schema["n_chars"].dataType)).alias("n_chars"))
    return out.select(*[swap.get(c, F.col(f"row.`{c}`").alias(c)) for c in names])


def _scan(least: float):
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n, digest, spans = [[], [], [], []], [], []
            for t in b.column("text").to_pylist():
                found = secret_spans(t, least)
                for k in range(4):
                    n[k].append(sum(x[1] == k for x in found))
                digest.append(hashlib.sha256(said([x for x in found if x[1] < 3]).encode()).hexdigest())
                spans.append(said(found))
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), *[pa.array(x, pa.int64()) for x in n], pa.array(digest, pa.string()),
                 pa.array(spans, pa.string())],
                ["doc_id", "n_assign", "n_access", "n_hex", "n_novel", "base_sha256", "spans"])
    return scan


PLACEHOLDER = "[REDACTED]"


def redacted(text: str | None, least: float) -> str | None:
    """``text`` with each secret replaced by a placeholder; of an assignment only the value is."""
    spans = secret_spans(text, least)
    if not spans:
        return text
    cuts = []
    for a, k, b in spans:
        if k == 0:
            a = ASSIGN.match(text, a).start(2)
        if cuts and a < cuts[-1][1]:
            cuts[-1][1] = max(b, cuts[-1][1])
        else:
            cuts.append([a, b])
    out, at = [], 0
    for a, b in cuts:
        out += [text[at:a], PLACEHOLDER]
        at = b
    return "".join(out) + text[at:]


def _redact(text_col: str, least: float):
    def redact(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = b.column("row").field(text_col).cast(pa.string()).to_pylist()
            clean = pa.array([redacted(t, least) for t in texts], pa.string())
            yield pa.RecordBatch.from_arrays([b.column("row"), clean], ["row", "clean"])
    return redact
