"""Word lists and limits of the claim rules. All values here are fixed: results depend on each of them."""

from __future__ import annotations

# fixed values: spaces matter, a needle may stand inside a word
QUESTION_STARTS = ["who ", "what ", "when ", "where ", "why ", "how ", "does ", "do ", "did ", "is ", "are "]
INSTRUCTION_STARTS = ["please ", "write ", "list ", "explain ", "describe ", "compare ", "tell ", "show ", "give ", "make ", "create "]
CLAIM_KINDS = [
    ("conditional", ["if ", " if ", "when ", "whenever ", "provided that", "only if", "implies"]),
    ("definition", [" is defined as ", "means ", "consists in ", "is the same as "]),
    ("normative", [" should ", " must ", " ought ", "required", "forbidden", "permitted", "obligated", "obligation"]),
    ("modal", ["necessarily", "possible", "possibly", "impossible", " can ", " could ", " may ", " might ", "contingent"]),
    ("universal", ["all ", " every ", "each ", " each ", "any ", " any ", "none ", " none ", "no ", " no "]),
]
PREDICATE_NEEDLES = [" is ", " are ", " was ", " were ", " has ", " have ", " causes ", " implies ", " requires ", " supports ", " contradicts "]
HEDGES = ["maybe", "perhaps", "arguably", "unclear"]
NEGATIONS = [" no ", " not ", " never ", " none ", " cannot ", " can't ", " without ", " false "]
DOMAINS = [
    ("metaphysics", ["being", "reality", "substance", "form", "essence", "exist"]),
    ("epistemology", ["knowledge", "truth", "belief", "justification", "reason"]),
    ("ethics", ["good", "justice", "virtue", "ought", "should", "duty"]),
    ("political_philosophy", ["state", "law", "rule", "political", "citizen"]),
    ("logic", ["valid", "implies", "contradiction", "necessary", "possible"]),
]
CONCEPTS = ["soul", "virtue", "truth", "knowledge", "justice", "good", "being", "essence", "reason", "belief", "freedom", "duty", "meaning"]
REPORTAGE = ["meeting", "chapter", "section", "page", "wrote", "said", "visited", "arrived", "published"]
CLEAR_PREDICATES = [" is ", " are ", " implies ", " requires ", " grounds ", " causes ", " constitutes ", " consists in ", " depends on ", " entails "]
LEXICON = ["knowledge", "truth", "justice", "virtue", "soul", "being", "form", "reason", "substance", "essence"]
RELATION_STOPWORDS = [
    "the", "and", "for", "that", "this", "with", "from", "into", "than", "then", "are", "was", "were", "has", "have", "had", "not", "all", "any", "each", "every",
    "its", "their", "his", "her", "one", "two",
]
CONTENT_STOPWORDS = [
    "the", "and", "for", "that", "this", "with", "from", "into", "than", "then", "are", "was", "were", "has", "have", "had", "not", "all", "any", "each", "every",
    "its", "their", "his", "her", "one", "two", "who", "what", "when", "where", "why", "how",
]
FINGERPRINT_STOPWORDS = ["the", "a", "an", "and", "or", "but", "that", "this", "these", "those", "of", "to", "for", "in", "on", "at", "by", "with", "from", "as"]
ABBREVIATIONS = ["Dr", "Mr", "Mrs", "Ms", "Prof", "St", "e\\.g", "i\\.e", "cf", "vs", "Phys", "Metaph", "Eth", "Rep", "Bk", "Ch"]
ROLE_SCORES = {
    "main_claim": 1.0, "conclusion": 0.9, "definition": 0.85, "premise": 0.7, "objection": 0.7, "reply": 0.7, "qualification": 0.55, "background": 0.35, "example": 0.35,
}
UNKNOWN_ROLE_SCORE = 0.25
COSINE_ANY, COSINE_SAME_PARAGRAPH = 0.74, 0.58
RELATED, OPPOSED, VARIANT = 0.28, 0.34, 0.72
STAGES = [
    "ingest", "segment", "embed", "cluster", "extract_claims", "classify_roles", "extract_terms", "reconstruct_arguments", "normalize_propositions", "formalize", "evaluate", "worldview",
]
#: The same characters as a string.
WHITE_CHARS = "".join(map(chr, [*range(0x9, 0xE), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]))
#: Unicode white space, written so that Java's and RE2's patterns agree.
WHITE = r"[\x{9}-\x{D}\x{20}\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"
