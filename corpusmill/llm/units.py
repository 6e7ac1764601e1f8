"""Units of a text (sentences, list items, cells, keywords) and what they are.

A unit is a sentence when it has clause structure: enough words that sentences
are made of for its length, and an end or a length that list items don't have.
Those words, and the words of selling phrases, come from a lexicon learned from
the corpus (``lexicon``). The lists below are only what is used without one, for
a few texts at hand. Everything here works on one unit at a time, so counts
over units add up in any order.
"""

from __future__ import annotations

import re

import numpy as np

# Fixed word lists. Words that open or join clauses, auxiliaries and pronouns:
CLAUSE_WORDS = frozenset(
    """
    and but that which who whom once when while where why how because although though until before after since if whether as than
    is are isn aren was were wasn weren be been has have had hasn haven don doesn didn won will would can could should must may might not they them their his her its it we you
    there this these those
    und aber dass daß weil wenn ob als ist sind war waren wird werden wurde hat haben hatte kann können muss müssen soll
    nicht kein nur noch auch er sie es ihr darüber doch gibt
    que qui quand mais est sont était ont sera seront avait plus ne pas elle ils cette ces
    pero porque cuando donde son fue han había será no se quién qué más ya hay está
    che ma perché quando dove è hanno sarà non si più ha
    mas porque onde é foi eram tem têm não há será
    en maar dat omdat wanneer waar waarom zijn waren wordt worden heeft hebben had zal moet niet geen alleen
    """.split()
)
# Articles, prepositions and the like:
SMALL_WORDS = frozenset(
    """
    the a an of to in on at by for from with against into over about between through per or
    der die das den dem des ein eine einen einem einer von zu zum zur mit im am an auf aus bei für nach um vor zwischen seit bis
    le la les l un une des du de d à au aux en dans sur par avec sans entre depuis selon pour
    el los las lo una unos del al con sin desde hasta según por para y o e
    il gli i uno della dello dei delle degli di da dal dalla nel nella su tra fra per
    os um uma do dos das em na nos nas ao pelo pela com sem até
    het een van te voor met op uit om tot tussen volgens sinds
    """.split()
)
# Words of selling phrases made for search:
SELLING_WORDS = frozenset(
    """
    buy cheap best price prices discount near me top review reviews free sale deal deals online shop
    kaufen billig günstig angebot angebote rabatt preis preisvergleich bestellen
    acheter cher meilleur prix soldes avis promo livraison gratuite gratuit ligne
    comprar barato oferta ofertas rebajas opiniones mejor precio línea linea envío envio gratis
    comprare economico offerta offerte sconto recensioni prezzo miglior spedizione gratuita acquista
    desconto promoção preço melhor avaliações frete grátis
    kopen goedkoop korting aanbieding beste prijs bestel
    """.split()
)
# Han characters of clauses, and selling words in Han:
CLAUSE_HAN = frozenset("的了在是和被将才请并与为但都还把很从到对也就而会说没不人")
SELLING_HAN = re.compile("优惠|便宜|打折|购买|价格|推荐|促销|特价|包邮|评价|最好|哪家好|附近")

#: A word stands by itself: letters next to digits are codes.
WORD = re.compile(r"\b[^\W\d_]+\b")
#: Where the words of a tag such as #bestNightCoach meet.
CAMEL = re.compile(r"(?<=[a-zß-ÿ0-9])(?=[A-ZÀ-Þ])")
HAN = re.compile(r"[㐀-䶿一-鿿]")
#: Where a unit ends: after the stop of a sentence, at line ends and at the marks that part cells and items.
BREAK = re.compile(r"(?<=[.!?])[\"”»)]*[ \t\r\xa0]+|(?<=[。！？；])|[\n;|\t]+")
LINK = re.compile(r"https?://|www\.|</?a[ >]|\]\(|»|>>|(?<![\w@.])[a-z0-9\-]+(?:\.[a-z0-9\-]+)*\.[a-z]{2,}/[\w\-]+", re.IGNORECASE)
TAG = re.compile(r"(?<!\w)#\w{4,}|\bSKU[- ]?\d")
_LETTER = re.compile(r"[^\W\d_]")
#: What a unit with a link has in it at least; tells cheaply that there is none.
_MAY_LINK = re.compile(r"[/»]|>>|www\.", re.IGNORECASE)
_MARK = re.compile(r"\s*(?:[-•*·–]|\(?\d{1,3}[.)])\s")
_ITEM = re.compile(_MARK.pattern + r"|[^/]*\w/\w")
_STOP = re.compile(r"[.!?。！？:][\"'”»)\]]*\s*$")
_STOPS = frozenset(".!?。！？:")
_CLOSING = "\"'”»)]"

SENTENCE, HEADING, ITEM, LINKS, TAGS, SELLING, JUNK = range(7)
KINDS = ("sentence", "heading", "item", "links", "tags", "selling", "junk")

#: Share of function words, and words, from which a unit is a sentence.
SMALL_SHARE, SENTENCE_WORDS, LONG_WORDS = 0.17, 5, 9


#: Words of a unit, with the characters of scripts without blanks one by one.
_SINGLE = "㐀-䶿一-鿿぀-ヿ฀-໿က-႟ក-៿"
TOKEN = re.compile(rf"[{_SINGLE}]|[^\W\d_{_SINGLE}]+")
_HAS_SINGLE = re.compile(f"[{_SINGLE}]")
#: Share of a lexicon's clause words from which a unit is a sentence, and from which one with selling words is.
CLAUSE_SHARE, CLAUSE_SHARE_SELLING = 0.2, 0.4


def tokens_of(unit: str) -> list[str]:
    """The lower-case words of a unit, those of tags apart."""
    if "#" in unit:
        unit = CAMEL.sub(" ", unit)
    return TOKEN.findall(unit.lower())


def ends_with_stop(unit: str) -> bool:
    """Whether a unit ends with the stop of a sentence."""
    text = unit.rstrip()
    return not text.endswith(":") and text.rstrip(_CLOSING)[-1:] in _STOPS


def judge(unit: str, lexicon=None) -> tuple[int, list[str], int]:
    """(kind, words, common) of a unit: its kind, lower-case words (Han characters one by one) and how many are common.

    Depends on nothing but the unit and the lexicon; without one, on the lists of this module.
    """
    return _judge_listed(unit) if lexicon is None else _judge_learned(unit, lexicon)


def _judge_learned(unit: str, lexicon) -> tuple[int, list[str], int]:
    words = tokens_of(unit)
    n = len(words)
    letters = sum(map(len, words))
    single = not unit.isascii() and _HAS_SINGLE.search(unit) is not None
    clause = sum(map(lexicon.clause.__contains__, words))
    selling = sum(map(lexicon.selling.__contains__, words))
    visible = len(unit) - unit.count(" ")
    links = _MAY_LINK.search(unit) and LINK.search(unit)
    prose = n >= SENTENCE_WORDS and clause >= (CLAUSE_SHARE_SELLING if selling else CLAUSE_SHARE) * n and letters >= 0.55 * visible
    if prose and ("SKU" in unit or "#" in unit) and TAG.search(unit):
        prose = False
    # an item may be a phrase with an article or two; a sentence has more, or no mark of an item
    marked = is_marked_item(unit)
    if prose and not links and (not marked or n >= LONG_WORDS and clause >= 2 * CLAUSE_SHARE * n):
        return SENTENCE, words, clause
    if links:
        # a link inside a sentence doesn't make it a link list
        return SENTENCE if prose and n >= LONG_WORDS and len(LINK.findall(unit)) == 1 else LINKS, words, clause
    if ("#" in unit or "SKU" in unit) and TAG.search(unit) and len(_LETTER.findall(unit)) >= 0.4 * visible:
        return TAGS, words, clause
    if selling:
        return SELLING, words, clause
    if letters < 0.5 * visible or not single and unreadable(words, letters):
        return JUNK, words, clause
    if single:
        return ITEM if "/" in unit or "、" in unit else HEADING, words, clause
    return ITEM if marked or n > 14 else HEADING, words, clause


#: What traits tells of a unit, in bits: it ends with a stop, may be a sentence by its letters and tags, has the mark of an item, has one link only.
STOP, OPEN, MARKED, ONE_LINK = 1, 2, 4, 8


def traits(unit: str, words: list[str]) -> tuple[int, int]:
    """(kind, bits) of a unit and its tokens_of, as far as no lexicon is needed: its kind if it has no common words, and STOP, OPEN, MARKED, ONE_LINK.

    OPEN, MARKED and ONE_LINK are told only where ``judge_all`` asks for them.
    """
    n = len(words)
    letters = sum(map(len, words))
    visible = len(unit) - unit.count(" ")
    links = _MAY_LINK.search(unit) and LINK.search(unit)
    tag = ("#" in unit or "SKU" in unit) and TAG.search(unit)
    bits = STOP if ends_with_stop(unit) else 0
    if n >= SENTENCE_WORDS and letters >= 0.55 * visible and not tag:
        bits |= OPEN
        if links and n >= LONG_WORDS and len(LINK.findall(unit)) == 1:
            bits |= ONE_LINK
    if links:
        return LINKS, bits
    marked = is_marked_item(unit)
    bits |= MARKED * marked
    if tag and len(_LETTER.findall(unit)) >= 0.4 * visible:
        return TAGS, bits
    single = not unit.isascii() and _HAS_SINGLE.search(unit) is not None
    if letters < 0.5 * visible or not single and unreadable(words, letters):
        return JUNK, bits
    if single:
        return ITEM if "/" in unit or "、" in unit else HEADING, bits
    return ITEM if marked or n > 14 else HEADING, bits


def judge_all(kind: np.ndarray, bits: np.ndarray, n: np.ndarray, clause: np.ndarray, selling: np.ndarray) -> np.ndarray:
    """The kinds that judge gives units with a lexicon, from their traits, words and how many of these are clause and selling words."""
    prose = (bits & OPEN > 0) & (clause >= np.where(selling > 0, CLAUSE_SHARE_SELLING, CLAUSE_SHARE) * n)
    long_ = (n >= LONG_WORDS) & (clause >= 2 * CLAUSE_SHARE * n)
    sentence = prose & np.where(kind == LINKS, bits & ONE_LINK > 0, (bits & MARKED == 0) | long_)
    other = np.where((selling > 0) & (kind != LINKS) & (kind != TAGS), SELLING, kind)
    return np.where(sentence, SENTENCE, other)


def _judge_listed(unit: str) -> tuple[int, list[str], int]:
    low = unit.lower()
    words = WORD.findall(low)
    n = len(words)
    letters = sum(map(len, words))
    if not low.isascii():
        chars = HAN.findall(low)
        han = len(chars)
        if han >= 4 and han * 2 >= letters:
            return _judge_han(unit, low, han), chars, sum(map(CLAUSE_HAN.__contains__, low))
    clause = sum(map(CLAUSE_WORDS.__contains__, words))
    selling = sum(map(SELLING_WORDS.__contains__, words))
    small = common = clause + sum(map(SMALL_WORDS.__contains__, words))
    if selling:  # small words inside selling phrases join no clauses
        if "ligne" in words or "línea" in words:
            phrase = words.count("en")
            small, clause = small - phrase, clause - phrase
        if "cher" in words:
            phrase = words.count("pas")
            small, clause = small - phrase, clause - phrase
        if "but" in words and ("au" in words or "de" in words):  # a goal, not a conjunction
            phrase = words.count("but")
            small, clause = small - phrase, clause - phrase
    visible = len(unit) - unit.count(" ")
    links = _MAY_LINK.search(unit) and LINK.search(unit)
    prose = n >= SENTENCE_WORDS and small >= SMALL_SHARE * n and letters >= 0.55 * visible
    if prose and selling and (clause <= 0 and (selling >= 2 or n <= 12) or selling >= 0.15 * n and clause <= 0.05 * n or selling >= max(2, 0.25 * n) and clause <= 0.15 * n):
        prose = False
    if prose and "SKU" in unit and TAG.search(unit):
        prose = False
    if prose and not links:
        if n >= LONG_WORDS or not _ITEM.match(unit) and (clause >= 1 and n >= 6 or _STOP.search(unit)):
            return SENTENCE, words, common
    if links:
        # a link inside a sentence doesn't make it a link list
        return SENTENCE if prose and n >= LONG_WORDS and clause and len(LINK.findall(unit)) == 1 else LINKS, words, common
    if ("#" in unit or "SKU" in unit) and TAG.search(unit) and len(_LETTER.findall(unit)) >= 0.4 * visible:
        return TAGS, words, common
    if selling and small <= SMALL_SHARE * n + 1:
        return SELLING, words, common
    if letters < 0.5 * visible or unreadable(words, letters):
        return JUNK, words, common
    return ITEM if _ITEM.match(unit) or not prose and n > 14 else HEADING, words, common


def _judge_han(unit: str, low: str, han: int) -> int:
    clause = sum(map(CLAUSE_HAN.__contains__, low))
    enough = clause >= 1 and low.rstrip()[-1] in "。！？；" if han < 20 else clause >= 2 and clause >= 0.05 * han
    if han >= 6 and enough and "/" not in low:
        return SENTENCE
    if LINK.search(unit):
        return LINKS
    if TAG.search(unit):
        return TAGS
    if SELLING_HAN.search(low):
        return SELLING
    return ITEM if "/" in low or "、" in low else HEADING


def is_marked_item(unit: str) -> bool:
    """Whether a unit begins with a list mark or number, or joins words by a slash."""
    return (_ITEM if "/" in unit else _MARK).match(unit) is not None


def kind_of(unit: str) -> int:
    """What a unit is; see KINDS."""
    return judge(unit)[0]


_VOWELS = re.compile(r"[aeiouyàáâãäåæèéêëìíîïòóôõöøùúûüœ]")


def unreadable(words: list[str], letters: int) -> bool:
    """True for words of any Latin-script text without the vowels that words have, or run together beyond 30 letters."""
    if letters < 12 or max(words[0]) > "ɏ":
        return False
    text = "".join(words)
    vowels = sum(map(text.count, "aeiouy")) if text.isascii() else len(_VOWELS.findall(text))
    return vowels < 0.2 * letters or letters > 30 * len(words)


def units_of(text: str) -> list[str]:
    """The non-blank units of text, in order."""
    return [u for u in BREAK.split(text) if u and not u.isspace()]
