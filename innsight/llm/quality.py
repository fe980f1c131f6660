"""Quality rules, line first: failing lines go, then documents that lost too much."""

from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from innsight.llm.common import map_text

SYMBOLS = b"#*$%&|<>"
BLANKS = b" \t\n\r\x0b\x0c"

# --- fixed values of the line rules
TERMINAL = tuple(".!?:;…\"'”’»)]}。！？．｡।॥؟۔።։။។")
SEPARATORS = {"|", "›", "»", "•", "·", "/", ">", "<", "::"}
NAVIGATION = {
    # English
    "about us", "back to top", "click here", "contact us", "home", "log in", "login", "menu", "next", "next page",
    "previous", "read more", "register", "search", "share", "sign in", "sign up", "site map", "skip to content",
    "subscribe", "view all",
    # French
    "accueil", "aller au contenu", "connexion", "contactez-nous", "en savoir plus", "lire la suite", "mentions légales",
    "page suivante", "partager", "plan du site", "précédent", "rechercher", "retour en haut", "s'abonner", "s'inscrire",
    "se connecter", "suivant", "tout afficher", "à propos",
    # German
    "alle anzeigen", "abonnieren", "anmelden", "datenschutz", "impressum", "kontakt", "mehr erfahren", "menü", "nach oben",
    "nächste seite", "registrieren", "startseite", "suchen", "teilen", "weiter", "weiterlesen", "zum inhalt springen", "zurück",
    "über uns",
    # Spanish
    "anterior", "aviso legal", "buscar", "compartir", "contacto", "iniciar sesión", "inicio", "leer más", "mapa del sitio", "menú",
    "página siguiente", "registrarse", "saltar al contenido", "siguiente", "sobre nosotros", "suscribirse", "ver todo",
    "volver arriba"}
BOILERPLATE = (
    # English
    "accept all cookies", "all rights reserved", "cookie policy", "enable javascript", "lorem ipsum", "powered by",
    "privacy policy", "terms of service", "terms of use", "this site uses cookies", "use of cookies",
    # French
    "accepter tous les cookies", "activer javascript", "ce site utilise des cookies", "conditions d'utilisation",
    "conditions d’utilisation", "politique de confidentialité", "politique de cookies", "tous droits réservés",
    # German
    "alle cookies akzeptieren", "alle rechte vorbehalten", "cookie-richtlinie", "datenschutzerklärung",
    "diese website verwendet cookies", "javascript aktivieren", "nutzungsbedingungen",
    # Spanish
    "aceptar todas las cookies", "condiciones de uso", "este sitio utiliza cookies", "habilitar javascript",
    "política de cookies", "política de privacidad", "términos de uso", "todos los derechos reservados")

#: A line of at least so many words must end like a sentence, or hold the end of one.
PROSE_WORDS = 8
#: Largest shares of a line's words that may carry symbols, stand apart as separators, shout, or be one and the same word
#: (or repeat the word before).
SYMBOL_SHARE, SEPARATOR_SHARE, SHOUT_SHARE, SAME_SHARE = 0.25, 0.2, 0.7, 0.5
#: A document must keep this share of the characters of its words.
KEEP_SHARE = 0.5

FIELDS = [T.StructField(n, T.LongType()) for n in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")]
FIELDS += [T.StructField("base_failed", T.BooleanType()), T.StructField("kept", T.BooleanType()),
           T.StructField("removed_chars", T.LongType())]


def line_fails(line: str, words: list[str]) -> bool:
    """Whether a line with words breaks the punctuation, navigation or boilerplate rule."""
    n = len(words)
    if n >= PROSE_WORDS and not any(w.endswith(TERMINAL) for w in reversed(words)):
        return True
    low = line.lower()
    if n <= 4 and low.strip(" \t\r\x0b\x0c.!:|»›") in NAVIGATION:
        return True
    if n <= 40 and any(p in low for p in BOILERPLATE):
        return True
    marks = sum(w in SEPARATORS for w in words)
    if marks >= 3 and marks > SEPARATOR_SHARE * n:
        return True
    if n < 5:
        return False
    if any(c in line for c in "#*$%&~^=@\\") and sum(map(_marked, words)) > SYMBOL_SHARE * n:
        return True
    if sum(len(w) > 1 and w.isupper() for w in words) > SHOUT_SHARE * n:
        return True
    if n < 10:
        return False
    echoes = sum(a == b for a, b in zip(words, words[1:]))
    return echoes > SAME_SHARE * n or Counter(words).most_common(1)[0][1] > SAME_SHARE * n


def _marked(word: str) -> bool:
    """A run of symbols at a word's end or start."""
    return word[-1] in "#*$%&~^=@\\" or word[0] in "#*$%&~^=\\"


def repeated_words(words: list, n: int = 5) -> int:
    """Words that lie in an n-word window found at least twice in the text, the first one included."""
    m = len(words) - n + 1
    if m < 2:
        return 0
    h = np.fromiter(map(hash, words), np.int64, len(words)).view(np.uint64)
    mix = np.zeros(m, np.uint64)
    for i in range(n):
        mix = mix * np.uint64(0x9E3779B97F4A7C15) + h[i:i + m]
    order = np.sort(mix)
    twice = order[1:][order[1:] == order[:-1]]
    if not len(twice):
        return 0
    # equal windows have equal hashes; compare the words themselves to leave out chance hits
    at = np.flatnonzero(np.isin(mix, twice))
    windows = [tuple(words[i:i + n]) for i in at]
    count = Counter(windows)
    hit = np.zeros(len(words) + 1, np.int64)
    for i, w in zip(at, windows, strict=True):
        if count[w] > 1:
            hit[i] += 1
            hit[min(i + n, len(words))] -= 1
    return int((np.cumsum(hit)[:-1] > 0).sum())


def judge(text: str | None) -> tuple:
    """The measures of one text, the verdict and the text without its failing lines."""
    raw = (text or "").encode("utf-8", "surrogatepass")
    solid = raw.translate(None, BLANKS)
    total = len(text or "") - (len(raw) - len(solid))
    words: list[bytes] = []
    seen: set[bytes] = set()
    dups, lost, kept_lines = 0, 0, []
    for line in raw.split(b"\n"):
        own = line.split()
        if not own:
            kept_lines.append(line)
            continue
        words += own
        if line in seen:
            dups += 1
        else:
            seen.add(line)
        shown = line.decode("utf-8", "surrogatepass")
        if line_fails(shown, [w.decode("utf-8", "surrogatepass") for w in own]):
            lost += len(shown) - (len(line) - len(line.translate(None, BLANKS)))
        else:
            kept_lines.append(line)
    n, rep = len(words), repeated_words(words)
    base = n < 10 or 100 * rep > 20 * n
    kept = not base and total - lost >= KEEP_SHARE * total
    clean = b"\n".join(kept_lines).decode("utf-8", "surrogatepass") if lost else text
    return n, total, len(solid) - len(solid.translate(None, SYMBOLS)), dups, rep, base, kept, lost, clean


def clean_documents(docs: DataFrame, text_col: str = "text", carry: list[str] | None = None,
                    with_text: bool = True) -> DataFrame:
    """Evaluate every line of every text by the punctuation, navigation and boilerplate rules.

    Words are runs without blanks (space, tab to carriage return); lines end
    at a line feed. Adds to the columns in ``carry`` (all, if None): n_words,
    word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed (under 10
    words, or over 20 % of them in repeated 5-word windows), ``kept`` (not
    base_failed, and the lines left hold at least half of the characters of
    all words), ``removed_chars`` and, if ``with_text``, ``clean_text``: the text without its failing lines. Columns of
    these names are replaced. A null text counts as empty: no words, not kept,
    null ``clean_text``. Rows are judged one by one, so repeated rows get equal results and an empty table none.
    """
    fields = FIELDS + ([T.StructField("clean_text", T.StringType())] if with_text else [])

    def make():
        def run(texts: pa.Array) -> list:
            rows = [judge(t.as_py()) for t in texts]
            return [list(c) for c in zip(*rows, strict=True)][:len(fields)] if rows else [[] for _ in fields]
        return run

    return map_text(docs, text_col, fields, make, carry)
