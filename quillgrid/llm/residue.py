"""What a leftover of a template, a filler text or a message of a failed page looks like.

Pure text rules, used by the residue operator and, for whole lines, by the furniture rules.
Detectors of three kinds:

* ``PLACEHOLDER``: unfilled or unrendered slots; they count anywhere in a text.
* ``MESSAGE``: a line that *is* a message of a failed, missing, blocked or checked page or a notice
  that scripts are needed; it must begin and end like one, so that a sentence of a story that
  speaks of denied access, outages or JavaScript does not match.
* filler: pseudo-Latin, found by the beginnings of its words.
"""

from __future__ import annotations

import re

PLACEHOLDER = re.compile(
    r"\{\{[^{}\n]{0,120}\}\}"  # {{ author }}
    r"|\{%[^%\n]{0,120}%\}"  # {% block x %}
    r"|<%[=\-]?[^%\n]{0,120}%>"  # <%= x %>
    r"|[$#]\{[^{}\n]{1,80}\}"  # ${x} #{x}
    r"|%%[A-Za-z][\w.\- ]{0,60}%%"  # %%NAME%%
    r"|\[\[[A-Za-z][\w .\-]{0,60}\]\]"  # [[headline]]
    r"|__[A-Z][A-Z0-9_]{1,40}__"  # __NAME__
    r"|\{[a-z]+(?:[_.][a-z0-9]+)+\}"  # {name_city}
    r"|\[(?:INSERT|YOUR|ADD|ENTER|PLACEHOLDER|TBD|TODO|FIXME)\b[^\[\]\n]{0,80}\]"
    r"|<(?:your |insert )?[A-Za-z_ \-]{0,40}\b(?:name|title|headline|quote|date|city|text|link|url) here>"
    r"|\[object [A-Z]\w+\]"
    r"|\bXX+ [^\n]{0,60}\bto come XX+\b|\bTK\b[^\n]{1,60}\bTK\b|\bTKTK\b|\bXXX+\b"
    r"|(?:^|(?<=[\s(:]))(?:TODO|FIXME)(?:[:\s]+(?:fill|add|insert|write|check|replace|update)\b)"
    r"|@@[A-Z_]{2,40}@@|\{[A-Z][A-Z0-9_]{2,40}\}"
    r"|&lt;%|\bMISSING_[A-Z_]+\b|\[\?\?\?\]"
)
#: A field or line made of nothing but values that were never rendered.
UNRENDERED = re.compile(r"^\W*(?:(?:undefined|null|nan|none|n/a|nil)\b[\W_]*){1,}$|^(?:[^\w]*\b(?:undefined|null|nan)\b[^\w]*(?:\w+[^\w]+)?){2,}$", re.I)
#: An instruction to write the text, in place of the text.
INSTRUCTION = re.compile(r"^(?:write|insert|add|enter|put|describe|replace|type)\b.{0,80}(?:<[^<>]{1,60}>.{0,20}\bhere\b|\bhere\b\W*$)", re.I)

_WHAT = r"(?:the |this |its |our |your |that )?"
#: So many of the patterns are notices that scripts are needed.
_SCRIPTS = 7
_MESSAGES = [
    # scripts
    r"(?:please |you (?:need|have) to |to [^.]{3,80}, (?:please )?|kindly )?(?:enable|turn on|activate|allow|switch on) java ?script\b.*",
    r".{0,160}\b(?:enable|turn on|activate) java ?script (?:to|and|in|for|before)\b.{0,160}",
    r".{0,80}\bjava ?script (?:is|seems to be|appears to be|must be) (?:disabled|required|needed|turned off|switched off|not (?:enabled|available)|off|blocked|enabled)\b.{0,160}",
    r".{0,80}\b(?:requires?|needs?|works? (?:only|best) with|does not work without|cannot (?:be shown|load) without) java ?script\b.{0,40}",
    r".{0,60}\bjava ?script (?:aktivieren|einschalten|zu aktivieren|activado|activer|requis|erforderlich|necesario|nécessaire)\b.{0,100}",
    r"(?:bitte |veuillez |por favor,? )?(?:aktivieren sie|activez|activer|active|habilite|habilitar|activar) (?:bitte )?(?:java ?script|(?:les |los |die )?scripts?)\b.{0,160}",
    r"(?:please )?(?:enable|turn on|activate|allow) (?:the )?scripts?\b.{0,160}|.{0,60}\bscripts? (?:are|is|must be) (?:required|needed|disabled|blocked|switched off|turned off)\b.{0,100}",
    # status lines
    r"(?:error|fehler|erreur|http(?:/\d(?:\.\d)?)?(?: error| status)?|status(?: code)?)[ :]*[45]\d\d\b.{0,120}",
    r"[45]\d\d(?:\s*[-–:|.]\s*|\s+)(?:bad gateway|not found|forbidden|unauthorized|bad request|internal server error|server error|service (?:temporarily )?unavailable|gateway time-?out|too many requests|gone|error|page not found|access denied|moved|request time-?out|payment required|method not allowed|temporarily unavailable)\b.{0,120}",
    r"(?:http )?[45]\d\d from .{2,80}",
    r"(?:bad gateway|gateway time-?out|service unavailable|internal server error|too many requests|page not found|not found|forbidden|access denied|unauthorized|bad request|request blocked|request timed out|connection (?:timed out|refused|reset)|permission denied|error|oops!?|nothing here|seite nicht gefunden|zugriff verweigert|page (?:introuvable|non trouvée)|accès refusé|página no encontrada|acceso denegado)(?:\s*[(\[].{0,80}[)\]])?(?:\s*[:;,–-]\s*.{0,100})?\W*",
    # missing pages
    rf"(?:sorry,? |oops!? |whoops!? )?{_WHAT}(?:page|url|address|document|article|file|resource|link|content|story|site)s?\b.{{0,90}}\b(?:could not be found|cannot be found|can['’]?t be found|was not found|not found|does not exist|doesn['’]?t exist|no longer (?:exists?|available|here)|has (?:been )?(?:moved|removed|deleted|gone)|is (?:gone|missing|not available))(?:\b.{{0,80}})?",
    r"(?:sorry,? |oops!? )?(?:we|i) (?:could not|couldn['’]?t|can['’]?t|cannot|were unable to|are unable to) (?:find|load|display|show|open|locate|reach) .{0,120}",
    r"the requested .{2,80}",
    # failed pages
    r"(?:\w+error|exception|fatal error|traceback|warning|uncaught \w+|parse error|syntax error|runtime error|error)\s*[:(].{2,200}",
    r"(?:something|an (?:unexpected )?error|a problem) (?:went wrong|has occurred|occurred|happened)\b.{0,120}",
    r".{2,80} is (?:currently |temporarily )?(?:down for (?:scheduled )?maintenance|under maintenance|offline|unavailable)\b.{0,80}",
    r".{0,40}\b(?:scheduled maintenance|be back (?:soon|shortly)|back shortly|try again (?:later|in (?:a few|some|\d+) \w+)|please (?:try again|reload|refresh|come back))\b.{0,80}",
    r"(?:connection|request|session|server|upstream|database|backend)\b.{0,60}\b(?:timed out|refused|reset|expired|closed|overloaded|did not respond|unreachable)\b.{0,80}",
    # blocked pages
    r"(?:your |the )?(?:access|request|connection|ip(?: address)?|visit|session)\b(?: to \S{1,80}| from \S{1,80})? (?:was|has been|is|were) (?:denied|blocked|refused|rejected|limited|restricted|banned|forbidden|logged)\b.{0,100}",
    r"you (?:have been|are|were|do not have|don['’]?t have) (?:blocked|banned|rate.?limited|not (?:allowed|authorized|permitted)|permission|access)\b.{0,120}",
    r"(?:ip|your ip|ip address|client ip|ray id|reference(?: id| number)?|incident(?: id)?|request id|error (?:code|id)|block id|support id|trace id|event id)\s*(?:[:#=]\s*\S.{0,80}|(?:was |is |has been )?logged\W*)",
    r".{0,60}\b(?:unusual (?:traffic|activity)|automated (?:queries|requests|access|traffic)|rate limit(?: exceeded)?)\b.{0,120}",
    # checked pages
    r"(?:please )?(?:verify|confirm|prove|check|verifying|checking) (?:that )?(?:you(?:['’]re| are)|if you are|whether you are) (?:a )?(?:human|not a robot|no robot|real)\b.{0,120}",
    r"(?:checking|verifying) (?:your |the |if the )?(?:browser|connection|site connection|device|session|request)\b.{0,120}",
    r"\W*(?:\[[ x]?\]\s*)?i['’]?(?:m| am) (?:no|not a|human)\b.{0,40}",
    r"(?:just a moment|one moment(?:,? please)?|please wait|hold on|loading|redirecting|wird geladen|chargement|cargando)\b\W*(?:(?:while|to|you) .{0,100})?\W*",
    r".{0,60}\b(?:complete|solve) the (?:captcha|security check|challenge|puzzle)\b.{0,80}|.{0,40}\bcaptcha\b.{0,40}",
    r"(?:security check|ddos protection|attention required|performance (?:&|and) security by|are you (?:a )?(?:human|robot))\b.{0,80}",
    r"(?:please )?enable cookies?(?: and java ?script)?\b.{0,100}|.{0,40}\bcookies (?:are|must be) (?:disabled|enabled)\b.{0,60}",
    r"(?:<!doctype html>.{0,20})?<(?:html|head|title|body|h1)\b[^>]*>.{0,200}|<!doctype html>.{0,200}|<\?xml .{0,100}|<noscript>.{0,200}",
    # place holders in words
    r"(?:(?:this is (?:a |some )?)?(?:placeholder|dummy|sample|filler|test) (?:text|content|copy|headline|title|page|article|paragraph|post)|content goes here|text goes here|coming soon|under construction|untitled(?: document)?|default (?:title|text)|your (?:text|title|content) (?:goes )?here|hello world!?|example (?:page|text|title))\b.{0,60}",
]
SCRIPTS = re.compile("^(?:" + "|".join(f"(?:{x})" for x in _MESSAGES[:_SCRIPTS]) + ")$", re.I | re.S)
MESSAGE = re.compile("^(?:" + "|".join(f"(?:{x})" for x in _MESSAGES) + ")$", re.I | re.S)
#: A line that is no short one can only be a message if it holds one of these (in lower case).
MESSAGE_KEYS = (
    "javascript", "java script", "script", "error", "exception", "denied", "blocked", "forbidden", "not found", "be found", "unavailable", "too many", "human", "robot", "browser", "moment",
    "maintenance", "<!doctype", "<html", "<title", "<noscript", "<body", "captcha", "please wait", "loading", "timed out", "refused", "ip logged", "was logged", "ray id", "reference",
    "no longer", "not exist", "t exist", "removed", "moved", "try again", "wrong", "oops", "sorry", "placeholder", "goes here", "permission", "gateway", "traffic", "rate limit",
    "cookies", "incident", "expired", "redirect", "unable", "could not", "couldn", "can't find", "nicht gefunden", "introuvable", "no encontrada", "checking", "verif",
    "security", "offline", "reload", "undefined", "null", "nan", " here", "the requested", "from ",
)

# The words of the printers' filler text and of the passages that generators add to it.
_LATIN = (
    "lorem ipsum dolor amet consectetur adipiscing elit eiusmod tempor incididunt labore dolore magna aliqua minim veniam quis nostrud exercitation ullamco laboris nisi aliquip commodo consequat"
    " duis aute irure reprehenderit voluptate velit esse cillum fugiat nulla pariatur excepteur sint occaecat cupidatat proident sunt culpa officia deserunt mollit anim laborum"
    " pellentesque habitant morbi tristique senectus netus malesuada fames turpis egestas vestibulum tortor quam feugiat vitae ultricies eget donec mauris placerat eleifend leo"
    " praesent dapibus neque cursus faucibus urna venenatis luctus ornare aliquam tincidunt curabitur maecenas suspendisse phasellus etiam vivamus aenean quisque lacus augue sapien ligula"
).split()
#: Filler is often garbled, so words count by their first letters.
STEM = 5
#: Beginnings of words of today's languages; of these only the whole word counts.
_AMBIGUOUS = frozenset("phase tempo labor dolor minim commo offic conse excep exerc repre incid magna curab venen place fauci".split())
STEMS = frozenset(w[:STEM] if w[:STEM] not in _AMBIGUOUS else w for w in _LATIN if len(w) >= STEM)
_FUNCTION = re.compile(r"\b(?:the|of|and|to|in|for|is|was|with|that|by|der|die|das|und|le|la|les|des|el|los|en|de|une?|von|im|zu|que|del)\b", re.I)
_WORD = re.compile(r"[^\W\d_]+")
BLANKS = re.compile(r"\s+")


def is_filler(line: str) -> bool:
    """Pseudo-Latin: two different words or more, and a fifth of all, begin like those of the filler, or one of its first two words is there; and no small word of a language stands between them."""
    words = _WORD.findall(line.lower())
    if len(words) >= 2 and not {"lorem", "ipsum"}.isdisjoint(words) and not _FUNCTION.search(line):
        return True
    hits = [w for w in words if w[:STEM] in STEMS or w in STEMS]
    return len(set(hits)) >= 2 and len(hits) * 5 >= len(words) and ("lorem" in words or not _FUNCTION.search(line))


_seen: dict[str, bool] = {}


def is_script_notice(line: str) -> bool:
    """Is a whole line a notice that scripts are needed?"""
    line = BLANKS.sub(" ", line).strip()
    return "script" in line.lower() and bool(SCRIPTS.match(line) or SCRIPTS.match(line.strip("#*_> -\"'")))


def is_message(line: str) -> bool:
    """Is a whole line a message, filler or unrendered value that stands in place of a story?"""
    line = BLANKS.sub(" ", line).strip()
    if not line:
        return False
    known = _seen.get(line)
    if known is None:
        if len(_seen) > 100_000:
            _seen.clear()
        bare = line.strip("#*_> -\"'").strip() or line
        known = _seen[line] = bool(MESSAGE.match(line) or MESSAGE.match(bare) or UNRENDERED.match(line) or INSTRUCTION.match(bare)) or is_filler(line)
    return known


#: Without one of these no placeholder can be there.
_SIGNS = ("{", "<%", "%%", "[[", "[INSERT", "[YOUR", "[ADD", "[ENTER", "[PLACEHOLDER", "[TBD", "[TODO", "[FIXME", "[object", "[???", "__", "XX", "TK", "TODO", "FIXME", "@@", " here>", "&lt;%", "MISSING_")


def has_placeholder(text: str) -> bool:
    return any(x in text for x in _SIGNS) and bool(PLACEHOLDER.search(text))
