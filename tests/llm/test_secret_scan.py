import hashlib
import random
import re

from llm_cases import edge_docs, edge_texts, empty_docs

from tillroll.llm import secret_scan as S

ASSIGN = (r"""([pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|"""
          r"""[aA][pP][iI]_?[kK][eE][yY])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")


def brute(text):
    """Base spans by the definition: find, then drop failing matches."""
    text = text or ""
    out = [(m.start(), 0, m.end()) for m in re.finditer(ASSIGN, text) if len(m[2]) >= 12]
    out += [(m.start(), 1, m.end()) for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m[0]) >= 18]
    out += [(m.start(), 2, m.end()) for m in re.finditer(r"[0-9a-f]+", text) if len(m[0]) >= 16]
    return sorted(out)


KEY = "Zk3vQ9xLr81TbW02hYqPn7sD"
MORE = [(20, f"Authorization: Bearer {KEY}"), (21, "authorization: bearer my_client_secret_key_name_v2"),
        (22, f"random text then {KEY}"), (23, "api key:\ncredentials 2024-2025-2026-2027"),
        (24, "tokenization of éé token='0123456789abcdef01234' end"), (25, "PASSWD=short secret=AKIAAKIA"),
        (26, "ſecret = abcdefghijklmnop"), (27, f"see the signature {KEY} and again {KEY}")]


def test_base_spans_by_brute_force():
    r = random.Random(5)
    texts = [t for _, t in edge_texts() + MORE]
    bits = ["token", "Api_Key", "apikey", "PASSWORD", "=", " : ", '"', "'", "AKIA", "AKIAABCDEFGHIJKLMN", "0123456789abcdef",
            "xyz", " ", "é", "\n", "-_.=", "abcdefghijkl", "Z9"]
    texts += ["".join(r.choice(bits) for _ in range(r.randint(1, 25))) for _ in range(3000)]
    for t in texts:
        assert (S.base_spans(t) if t else []) == brute(t), t


def test_novelty_tells_keys_from_names():
    assert S.novelty(KEY, "authorization bearer ", "") >= 0.9
    assert S.novelty("client_secret_access_key", "", "") < S.LEAST
    assert S.novelty(KEY, f"seen before {KEY} ", "") < S.LEAST


NAMES = ("SECRET_KEY = '", "secretKey: '", "token_value=", "password_prod = '", "Authorization: Bearer ",
         '"private_key":\n    "')
ALPHABETS = {"hex": "0123456789ABCDEF", "base32": "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567",
             "base64": "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"}


def test_random_strings_of_any_length_and_alphabet_are_found():
    for kind, alphabet in ALPHABETS.items():
        for n in (16, 24, 32, 48, 64, 88, 128, 256, 400, 800, 2000):
            found = tried = 0
            for k in range(24):
                key = "".join(random.Random(f"{kind} {n} {k}").choices(alphabet, k=n))
                if any(map(str.isdigit, key)) and any(map(str.isalpha, key)):
                    name = NAMES[k % len(NAMES)]
                    tried += 1
                    found += (len(name), 3, len(name) + n) in S.secret_spans(f"{name}{key}' # end", S.LEAST)
            assert found >= 0.95 * tried, (kind, n, found, tried)


def test_long_names_and_words_are_no_secrets():
    texts = ["the passage /en/articles/2024/how-to-make-the-best-bread-in-your-own-kitchen-without-an-oven-and-other-stories",
             "token_file = /usr/local/share/application/config/version2/default/token/settings/production/template/data",
             "secret_name: " + "name_of_the_service_account_in_region_2_" * 6,
             "tokenization of " + KEY, "by the author " + KEY]
    assert [S.secret_spans(t, S.LEAST) for t in texts] == [[]] * len(texts)


def test_edge_rows_and_novel_spans(spark):
    rows = edge_texts() + MORE
    out = S.scan_secrets(edge_docs(spark, rows)).collect()
    want = []
    for i, t in rows:
        base = brute(t)
        n = [sum(k == x for _, x, _ in base) for k in range(3)]
        want.append((i or -1, *n, hashlib.sha256(S.said(base).encode()).hexdigest()))
    assert sorted((r.doc_id or -1, r.n_assign, r.n_access, r.n_hex, r.base_sha256) for r in out) == sorted(want)
    novel = {r.doc_id: r.spans for r in out if r.n_novel}
    assert set(novel) == {20}
    assert novel[20] == f"novel:22:{22 + len(KEY)}"
    assert S.scan_secrets(empty_docs(spark)).count() == 0


def test_redaction_removes_secrets_and_nothing_else(spark):
    rows = edge_texts() + MORE
    docs = edge_docs(spark, rows)
    out = S.scan_secrets(docs, redact=True)
    assert out.columns == docs.columns and out.count() == len(rows)
    texts = {}
    for r in out.collect():
        texts.setdefault(r.doc_id, []).append(r)
    for i, t in rows:
        for r in texts[i]:
            if S.secret_spans(t, S.LEAST):
                assert S.PLACEHOLDER in r.text and not S.secret_spans(r.text, S.LEAST) and r.n_chars == len(r.text)
            elif i is not None:
                assert r.text == t and r.n_chars == (None if t is None else len(t))
    assert S.redacted("token = 'abcdefghijklmnop' x", S.LEAST) == "token = '[REDACTED]' x"
