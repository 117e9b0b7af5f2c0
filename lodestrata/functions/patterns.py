"""Patterns and word lists. All are fixed values of the data formats handled here.

They avoid classes whose meaning depends on flags: SPACE is every white-space character, DIGIT every decimal digit, so that a pattern
means the same in any engine with these escapes.
"""

SPACE = r"[\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
NONSPACE = r"[^\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
DIGIT = r"\p{Nd}"
WORD = r"[\p{L}\p{N}_]"

# line ends: every form of line break counts, CR LF as one
LINE_BREAK = r"\r\n|[\n\r\x0b\x0c\x1c-\x1e\x{85}\x{2028}\x{2029}]"

# artefacts of text extraction
SPAN_TAG = r"(?i)<span[^>]*>|</span>"
DOUBLE_FOOTNOTE = rf"(?i)<sup>&</sup>lt;sup>{DIGIT}+</sup>"
LEFT_FOOTNOTE = rf"(?i)lt;sup>{DIGIT}+</sup>"
FOOTNOTE = rf"(?i)<sup>{DIGIT}+</sup>"
MATH_SUP = rf"(?i)<sup>(?!{DIGIT}+</sup>)([^<]{{1,10}})</sup>"
MATH_SUB = rf"(?i)<sub>(?!{DIGIT}+</sub>)([^<]{{1,10}})</sub>"
PAGE_IMAGE = rf"(?i)!\[\]\(_page_{DIGIT}+_[^)]+\.(?:jpg|jpeg|png|gif|webp|svg|tif|tiff)\)"
ANY_SUP = r"(?is)<sup>.*?</sup>"
LINE_TAG = rf"(?i)<br{SPACE}*/?>"
UNSEEN = r"[\x{ad}\x{200b}\x{200c}\x{200d}\x{feff}]"
PAGE_NUMBER = rf"(?i)^{SPACE}*(?:page{SPACE}+)?{DIGIT}{{1,4}}(?:{SPACE}+of{SPACE}+{DIGIT}{{1,4}})?{SPACE}*$"
FORMULA_SIGN = r"[\\|`${}]"

# headings
NUMBERED_CODE = rf"^{SPACE}*{DIGIT}{{2,5}}{SPACE}+[A-Za-z'`]"
ATX = rf"^#{{1,6}}{SPACE}+{NONSPACE}"
ATX_MARK = rf"^#{{1,6}}{SPACE}+"
PSEUDOCODE = rf"(?i)^(?:input|output|step{SPACE}*{DIGIT}|procedure|function|return|if|else|end){SPACE}*[:\p{{Nd}}]?$"
NUMBERED_HEADING = rf"^{DIGIT}+(?:\.{DIGIT}+)*\.?{SPACE}{{1,4}}[A-Z][a-z]"
NAMED_HEADING = rf"^(?:Algorithm|Theorem|Lemma|Proof|Corollary|Definition|Remark|Example|Exercise){SPACE}*[\p{{Nd}}.:]"
EMPHASIS = r"[*_`#]"
SECTION_NAME = rf"(?i)^(?:references?|bibliography|acknowledgements?|acknowledgments?|further{SPACE}+reading|preface|foreword|abstract|appendix|index|contents?|notation|glossary){SPACE}*$"
BOILERPLATE = (
    rf"(?i)^(?:references?|bibliography|acknowledgements?|acknowledgments?|further{SPACE}+reading|index|articles?{SPACE}+you{SPACE}+may{SPACE}+be{SPACE}+interested{SPACE}+in"
    rf"|related{SPACE}+content|cited{SPACE}+by|recommended{SPACE}+articles?|supplementary{SPACE}+(?:material|data|information)"
    rf"|author{SPACE}+(?:information|affiliations?|contributions?)|funding{SPACE}+information|conflicts?{SPACE}+of{SPACE}+interest|data{SPACE}+availability){SPACE}*$"
)
HEADING_PAGE = rf"{SPACE}+{DIGIT}{{2,4}}$"

# noise
TOC_ENTRY = rf"^{SPACE}*(?:{DIGIT}+\.[\p{{Nd}}.]*{SPACE}+{NONSPACE}|•|–|-){SPACE}*.{{3,60}}(?:\.{{3,}}|{SPACE}{{3,}}){SPACE}*{DIGIT}{{1,4}}{SPACE}*$"
BARE_URL = rf"^{SPACE}*(?:https?://|www\.){NONSPACE}+{SPACE}*$"
PROSE_WORD = r"[a-zA-Z]{3,}"
LATEX = r"\\(?:frac|int|sum|prod|partial|nabla|cdot|times|alpha|beta|gamma|delta|sigma|omega|lambda|mu|pi|theta|phi|psi|hat|bar|vec|mathbf|mathrm)\b|\$\$"

# openings that make no sense without the sentence before
ORPHAN = (
    rf"(?i)^(?:\([\p{{Nd}}.A-Za-z]+\){SPACE}*[,;]|eq(?:uation)?s?\.?{SPACE}*\(|(?:therefore|thus|hence|consequently|accordingly),?{SPACE}"
    rf"|(?:this|these|those|its|their){SPACE}+(?:{WORD}+{SPACE}+)?(?:gives?|shows?|implies?|is\b|are\b|means?|yields?|results?)"
    rf"|where{SPACE}+[A-Za-z_]{WORD}*{SPACE}+(?:is|are|denotes?|represents?)|with{SPACE}+[A-Za-z_]{WORD}*{SPACE}+(?:being|denoting)"
    rf"|in{SPACE}+which{SPACE}|into{SPACE}*\(|from{SPACE}+\(|substitut{WORD}+{SPACE}+(?:into{SPACE}+)?\()"
)

# metadata
PLACEHOLDER_TITLE = (
    rf"(?i)^(?:microsoft{SPACE}+word{SPACE}*[-–—]|untitled\b|document{SPACE}*{DIGIT}*\b|new{SPACE}+document\b|temp(?:orary)?\b|draft\b|\.docx?\b"
    rf"|presentation{SPACE}*{DIGIT}*\b|workbook{SPACE}*{DIGIT}*\b|copy{SPACE}+of\b|revision{SPACE}+{DIGIT})"
)
PLACEHOLDER_AUTHOR = rf"(?i)^(?:[a-z]{{1,3}}|unknown|author|user|admin|default|n/?a|na|{DIGIT}+){SPACE}*$"
PDF_DATE = r"^D:(\p{Nd}{4})(\p{Nd}{2})(\p{Nd}{2})"
ARCHIVE_TAG = "Anna's Archive"
ARCHIVE_STEM = rf"(?i)^(.+?){SPACE}+--{SPACE}+(.+?){SPACE}+--{SPACE}+.+--{SPACE}+Anna's{SPACE}+Archive$"

SUFFIXES = ("pdf", "txt", "md", "markdown", "csv")
