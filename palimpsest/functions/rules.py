"""What the wiki-text operators look for. Pass other lists for another wiki or language."""

# Sections that are left out, and sections that end a page.
FOOTNOTE_SECTIONS = [
    "Notes", "Note", "Explanatory notes", "Informational notes", "Footnotes", "Explanatory footnotes",
]
REFERENCE_SECTIONS = [
    "References", "Citations", "References cited", "Cited texts", "Cited text", "Cited books", "Books cited",
    "Cited literature", "Cited sources", "Cited works", "Works cited", "Specialised works",
    "Works by involved parties", "Sources", "Sources cited", "Other sources", "General and cited sources",
    "Book sources", "Literary sources", "Online sources", "Primary sources", "Secondary sources",
    "Print sources", "Books and journals", "Books and articles", "Works consulted", "Maps",
    "Notes, citations and source", "Notes, references and sources", "Notes and references", "Further reading",
    "General bibliography", "Bibliography", "Biographies", "General histories", "Periodicals",
    "Certifications", "External links", "Photos and additional information", "See also",
]

# Templates that are dropped. A template goes if its name starts with one of these, so names that start
# with another one of them are not needed here.
IGNORED_TEMPLATES = [
    "featured article", "other", "further", "more", "Tropical cyclone naming", "confuse", "dist", "ntbcw",
    "For", "About", "Main", "clear", "plainlist", "use", "EngvarB", "DISPLAYTITLE", "DEFAULTSORT", "TOC",
    "stack", "bots", "discuss", "clarify", "update", "cleanup", "tooltip", "failed verification", "unreliable",
    "page needed", "clarification needed", "attribution needed", "unreferenced section", "better source",
    "empty section", "Year missing", "vague", "outdated", "dubious", "under construction", "underconstruction",
    "one source", "Track list", "tracklist", "subst", "pb", "lead too long", "too long", "good article",
    "Commons cat", "bywhom", "by whom", "what", "when", "which", "who", "why", "as of when", "copyvio",
    "Copy edit", "cs1", "ct", "db-nocontext", "delete", "disambiguation", "dn", "dab needed", "explain",
    "Histmerge", "verify spelling", "awkward", "how many", "huh", "pp", "infobox", "campaignbox",
    "election box", "succession box", "quote box", "quotebox", "Speciesbox", "AFB game box", "Starbox",
    "Orbitbox", "weather box", "U.S. presidential ticket box", "bar", "Certification Table",
    "Certification Cite", "cantata discography", "taxobox", "automatic taxobox", "Album ratings", "taxonbar",
    "gallery", "nba player statistics", "WNBA player statistics", "footballbox", "americanfootballbox",
    "amfootballscoresummary", "episode table", "cyclingteamlist", "tc stats table", "gta table", "chembox",
    ":list of ", "Video game reviews", "Undergroundconnect", "Elections", "Apollo11series", "ahnentafel",
    "Antisemitism sidebar", "Constitution of Australia infobox", "Dinogloss", "Geobox", "HistBaseball nav",
    "mycomorphbox", "Paleogene graphical timeline", "Video game timeline", "Warof1812-Origins",
    "Madagascar bats", "Football kit box", "Cast list", "Atlantic hurricane best track",
    "EPAC hurricane best track", "cladogram", "clade", "Tree chart", "chart", "cretaceous graphical timeline",
    "Image", "wide image", "wideimage", "tallimage", "tall image", "annotated image", "annotatedimage",
    "double image", "BrokenImage", "css image crop", "Multiple", "Listen", "Audio", "Location", "short",
    "storm path", "external media", "webarchive", "wikisource", "Spoken Wikipedia", "maplink", "anchor",
    "dead link", "BoM_TC_Database", "sfn", "MSW3 Sfn", "snf", "Explanatory footnote", "efn", "Cite",
    "citation", "cn", "full citation needed", "fact", "uncited", "wikicite", "also", "free access",
    "open access", "closed access", "subscription", "r", "#tag:ref", "doi", "note", "cref", "see", "details",
    "hatnote", "family name hatnote", "third-party inline", "lom", "ISBN", "Harvs", "harvc", "Harvnb",
    "Full citations needed", "inote", "col ", "div", "sidebar",
]

# Templates without parameters that stand for a text.
TEMPLATE_TEXTS = {
    "nbsp": ' ',
    "nbsp;": ' ',
    "nbs": ' ',
    "&nbsp": ' ',
    "space": ' ',
    "spcs": ' ',
    "'": "'",
    "''": "''",
    '`': "'",
    "'-": '"\'',
    "-'": '\'"',
    '-"': '"\'',
    '"\'': '"\'',
    '" \'': '"\'',
    '\'"': '\'"',
    '\' "': '\'"',
    "'s": "'s",
    "+": '⁺',
    "-": '⁻',
    "--)": ')',
    "dash": ' - ',
    "ndash": ' - ',
    "em dash": ' - ',
    "emdash": ' - ',
    "endash": ' - ',
    "snd": ' - ',
    "spnd": ' - ',
    "sndash": ' - ',
    "snds": ' - ',
    "spndash": ' - ',
    "spaced ndash": ' - ',
    "spaced endash": ' - ',
    "spaced en dash": ' - ',
    "nsmdns": '—\u200c',
    "mdash": '-',
    "en dash": '-',
    "hyphen": '-',
    "break": '\n',
    "spaces": ' ',
    "CURRENTYEAR": '2024',
}

# Templates that open a table of templates, and the one that closes it.
TABLE_TEMPLATES = {
    "end u.s. presidential ticket box": ['start u.s. presidential ticket box'],
    "nat fs end": ['national football squad start', 'nat fs start', 'national football squad start (recent)', 'nat fs r start', 'national football squad start (goals)', 'nat fs g start'],
}
