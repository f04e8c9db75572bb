"""Values that define the results: codes, word lists, patterns, cut-offs.

Everything here is a fixed value that must not be tuned: changing one changes
what an extraction returns.  Functions elsewhere take these as defaults.
"""

# ---------------------------------------------------------------------------
# Sentinels, keys and cut-offs
# ---------------------------------------------------------------------------
NOT_STATED = "NÃO INFORMADO"
NOT_STATED_SPELLINGS = ("não informado", "nao informado")
POSITIVE = "POSITIVO"
NEGATIVE = "NEGATIVO"
INCONCLUSIVE = "INCONCLUSIVO"
CARE_LINE = "mama"

# Report keys of the two source groups; group P upserts on three of its four.
REPORT_KEYS = {
    "F": ("ficha", "id_item", "id_subitem"),
    "P": ("ficha", "sigla_exame", "id_marca", "sequencial"),
}
MERGE_KEYS = {
    "F": ("ficha", "id_item", "id_subitem"),
    "P": ("ficha", "sequencial", "sigla_exame"),
}

DAYS_PER_YEAR = 365.25
AGE_FROM, AGE_BELOW = 40, 76
REMINDER_CATEGORIES = (1, 2, 3)
RETURN_MONTHS = {1: 12, 2: 12, 3: 6}
RETURN_DAYS = {1: 360, 2: 360, 3: 180}
HIGHEST_CATEGORY = 6
KI67_CUT = 14
ACCEPTANCE_RATE = 0.8

# ---------------------------------------------------------------------------
# Exam codes by stage and group
# ---------------------------------------------------------------------------
EXAM_CODES = {
    "mammogram": {
        "F": ("MAMOG", "MAMOGDIG", "MAMOPROT", "MAMOG3D"),
        "P": ("MAMO", "MAMODI"),
    },
    "biopsy": {
        "F": ("BIOMAMUSCORE", "BIOMAMUSPAAF", "BIOMAMUS", "MAMOTOMIA",
              "MAMOTOMUS", "MAMCLIPE", "MAMOTORM"),
        "P": ("USPCOB", "CBGEST", "USPAFI", "ESMATO", "USMATO", "MPMFECG",
              "RMMATO", "USPMAF"),
    },
    "pathology": {
        "F": ("ANATPATP", "CTPUNC", "FISHHER"),
        "P": ("MICROH", "FPAH"),
    },
    "ihc": {
        "F": ("IH-NEO", "IHMAMA"),
        "P": ("IHMAMA",),
    },
    "return": {
        "F": ("MAMOG", "MAMOG3D", "MAMOGDIG", "MAMOPROT", "USMAMAS",
              "USMAMASD", "RMMAMAS"),
    },
}

# Fixed values: (code, code in the other group, description, stage)
EXAM_DIMENSION = (
    ("USMAMAS", "USMAX", "US MAMA E AXILA", "imaging"),
    ("MAMOGDIG", "MAMODI", "MAMOGRAFIA DIGITAL", "imaging"),
    ("MAMOG", "MAMO", "MAMOGRAFIA", "imaging"),
    ("RMMAMAS", "RMMAMO", "RM DE MAMA", "imaging"),
    ("MAMOPROT", None, None, "imaging"),
    ("USMAMASD", "USMADC", "US DAS MAMAS COM DOPPLER COLORIDO", "imaging"),
    ("RMMAMASPROTE", None, None, "imaging"),
    ("MAMOGH", None, None, "imaging"),
    ("MAMOG3D", None, None, "imaging"),
    ("USMAMASRECONV", "USMA", "US DA MAMA", "imaging"),
    ("BIOMAMUSCORE", "USPCOB", "PUNCAO POR AGULHA GROSSA DAS MAMAS", "biopsy"),
    ("BIOMAMUSPAAF", "CBGEST", "CORE BIOPSY DE MAMA (GUIADA POR ESTEREOTAXIA)", "biopsy"),
    ("BIOMAMUS", "USPAFI", "US MAMAS AGULHA FINA PUNCAO", "biopsy"),
    ("MAMOTOMIA", "ESMATO", "MAMOTOMIA POR ESTEREOTAXIA", "biopsy"),
    ("MAMOTOMUS", "USMATO", "MAMOTOMIA POR ECOGRAFIA", "biopsy"),
    ("MAMCLIPE", "MPFECG", "MARCAÇÃO PRÉ-CIRUR. POR FIO METÁLICO POR ECOGRAFIA", "biopsy"),
    ("MAMOTORM", "RMMATO", "MAMOTOMIA GUIADA POR RM", "biopsy"),
    ("ANATPATP", "MICROH", "MICRO-HISTOLOGIA (BIÓPSIA ECOENDOSCOPIA)", "pathology"),
    ("CTPUNC", "MICROH", "MICRO-HISTOLOGIA (BIÓPSIA ECOENDOSCOPIA)", "pathology"),
    ("FISHHER", "FPAH", "FISH - PESQUISA DE AMPLIFICAÇÃO DE HER-2", "pathology"),
    ("IH-NEO", "IHMAMA", "PAINEL IMUNOHISTOQUÍMICO PARA MAMA (APC)", "ihc"),
    ("IH-MAMA", "IHMAMA", "PAINEL IMUNOHISTOQUÍMICO PARA MAMA (APC)", "ihc"),
    ("PAINELMAMA", "P-CH16", "PAINEL PARA CÂNCER DE MAMA E OVÁRIO HEREDITÁRIOS", "complementary"),
    ("BRCA1E2", "BRICASQ", "BRCA1 E BRCA2 - SEQUENCIAMENTO GÊNICO COMPLETO", "complementary"),
    ("BRCA1E2SEQSOLO", "BRCAS1", "BRCA1 E BRCA2 - SEQUENCIAMENTO GENICO COMPLETO", "complementary"),
    ("BRCA2MLPA", "P-BRCA", "BRCA1 E BRCA2, PAINEL - SEQUENCIAMENTO E MLPA", "complementary"),
    ("BRCA1MLPA", "P-BRCA", "BRCA1 E BRCA2, PAINEL - SEQUENCIAMENTO E MLPA", "complementary"),
    ("BRCA1FAM", "BRCA1M", "BRCA1 - MUTAÇÃO FAMILIAR", "complementary"),
    ("BRCA2FAM", "P-CH16", "PAINEL PARA CÂNCER DE MAMA E OVÁRIO HEREDITÁRIOS", "complementary"),
    ("BRCA1", "BRCAS1", "BRCA1 E BRCA2 - SEQUENCIAMENTO GENICO COMPLETO", "complementary"),
    ("BRCA2", "BRCAS2", "BRCA1 E BRCA2 - SEQUENCIAMENTO GENICO COMPLETO", "complementary"),
    ("BRCASOMATICO", "BRCA-T", "SEQUENCIAMENTO BRCA1 E BRCA2 EM AMOSTRA DE TUMOR", "complementary"),
    ("BRCAASHK", "JUDASH", "PAINEL GENÉTICO JUDEU ASHKENAZI", "complementary"),
    ("AKCRMMAMAS", None, None, "complementary"),
    ("CINTMAMA", "CIMAMA", "CINTILOGRAFIA DE MAMA (BILATERAL)", "complementary"),
    ("DUCTOG", "RXDUCT", "DUCTOGRAFIA", "complementary"),
)

# ---------------------------------------------------------------------------
# Imaging category patterns
# ---------------------------------------------------------------------------
CATEGORY_NOISE = r"[-:®]|\xa0"
SECTION_HEADERS = r"AVALIA[CÇ][AÃ]O|CONCLUS[AÃ]O|IMPRESS[AÃ]O|OPINI[AÃ]O"
CATEGORY_KEYWORDS = {
    "F": r"BIRADS|CATEGORIA",
    "P": r"BIRADS|CATEGORI[AO]|CATEGORA|CATEGORIA R",
}
CATEGORY_VALUES = r"\d+\w*|VI|V|IV|III|II|I"
ROMAN_VALUES = {"I": 1, "II": 2, "III": 3, "IV": 4, "V": 5, "VI": 6}
DOCUMENTED_BEFORE, DOCUMENTED_AFTER = 5, 15

# ---------------------------------------------------------------------------
# Pathology word lists and patterns
# ---------------------------------------------------------------------------
TOPOGRAPHY_BREAST = r"Topografia: mama"
CARCINOMA_LINE = r"(?mi).*Topografia:.*MAMA.*(CARCINOMA).*|.*(CARCINOMA).*Topografia:.*MAMA.*"
MALIGNANCY_TERMS = (
    "carcinoma", "invasivo", "invasor", "sarcoma", "metástase", "metastático",
    "maligno", "maligna", "cdi", "cli", "cdis",
)
HISTOLOGIC_TYPES = (
    "carcinoma de mama ductal invasivo",
    "carcinoma de mama ductal in situ",
    "carcinoma de mama lobular invasivo",
    "carcinoma de mama lobular",
    "carcinoma de mama papilífero",
    "carcinoma de mama metapl[aá]sico",
    "carcinoma de mama mucinoso",
    "carcinoma de mama tubular",
    "carcinoma de mama c[ií]stico adenoide",
    "carcinoma de mama medular",
    "carcinoma de mama micropapilar",
    "carcinoma de mama misto (ductal e lobular) invasivo",
)
# The two phrases above that carry a character class, in plain spelling.
HISTOLOGIC_TYPES_PLAIN = {
    "carcinoma de mama metapl[aá]sico": "carcinoma de mama metaplásico",
    "carcinoma de mama c[ií]stico adenoide": "carcinoma de mama cístico adenoide",
}
HISTOLOGIC_GRADE = r"grau\s+histol[oó]gico\s*[:\-]?\s*(\d)"
NUCLEAR_GRADE = r"grau\s+nuclear\s*[:\-]?\s*(\d)"
TUBULE_SCORE = r"forma[cç][aã]o\s+de\s+t[uú]bulos\s*[:\-]?\s*(\d)"
MITOTIC_INDEX = {
    1: r"mit[oó]tico\s*[:\-]?\s*(\d+)\s*/?\s*\d*\s*mm2",
    2: r"mit[oó]tico\s*[:\-]?\s*(\d+)(?:\s*/\s*\d+)?\s*(?:mitoses?|mitose)?\s*/?\s*mm2",
}

# ---------------------------------------------------------------------------
# Immunohistochemistry patterns, by version, in test order.
# A rule is (pattern, label) or (pattern, {captured score: label}).
# ---------------------------------------------------------------------------
SCORE_LABELS = {"0": NEGATIVE, "0+": NEGATIVE, "1+": NEGATIVE,
                "2+": INCONCLUSIVE, "3+": POSITIVE}
BARE_SCORE_LABELS = {"1+": NEGATIVE, "2+": INCONCLUSIVE, "3+": POSITIVE}

ER_RULES = {
    1: (
        (r"receptor\s+de\s+estrog[eê]genio\s*[:\-]?\s*positivo", POSITIVE),
        (r"receptor\s+de\s+estrog[eê]genio\s*[:\-]?\s*negativo", NEGATIVE),
        (r"\ber\s*[\+]\b", POSITIVE),
        (r"\ber\s*[\-]\b", NEGATIVE),
    ),
    2: (
        (r"receptor\s+de\s+estr[oó]g(?:[eê]nio|eno)\s*[:\-]?\s*positivo", POSITIVE),
        (r"receptor\s+de\s+estr[oó]g(?:[eê]nio|eno)\s*[:\-]?\s*negativo", NEGATIVE),
        (r"\ber\s*[\+]\b", POSITIVE),
        (r"\ber\s*[\-]\b", NEGATIVE),
    ),
}
PR_RULES = {
    1: (
        (r"receptor\s+de\s+progesterona\s*[:\-]?\s*positivo", POSITIVE),
        (r"receptor\s+de\s+progesterona\s*[:\-]?\s*negativo", NEGATIVE),
        (r"\bpr\s*[\+]\b", POSITIVE),
        (r"\bpr\s*[\-]\b", NEGATIVE),
    ),
    2: (
        (r"receptor\s+de\s+progesterona[*]?(.{0,45}?)positivo\b", POSITIVE),
        (r"receptor\s+de\s+progesterona[*]?(.{0,45}?)negativo\b", NEGATIVE),
        (r"\bpr\s*[\+]\b", POSITIVE),
        (r"\bpr\s*[\-]\b", NEGATIVE),
    ),
    3: (
        (r"receptor\s+de\s+progesterona\s*-\s*negativo\b", NEGATIVE),
        (r"receptor\s+de\s+progesterona\s*-\s*positivo\b", POSITIVE),
        (r"receptor\s+de\s+progesterona[*]?(.{0,60}?)negativo\b", NEGATIVE),
        (r"receptor\s+de\s+progesterona[*]?(.{0,60}?)positivo\b", POSITIVE),
        (r"\bpr\s*[\+]\b", POSITIVE),
        (r"\bpr\s*[\-]\b", NEGATIVE),
    ),
}
HER2_RULES = {
    1: (
        (r"her[-\s]?2.*?escore\s*[:\-]?\s*([0-3]\+?)", SCORE_LABELS),
        (r"\bher[-]?2\s*[:\-]?\s*([0-3]\+)\b", BARE_SCORE_LABELS),
    ),
    2: (
        (r"her[-\s]?2\s*[:\-]?\s*positivo\b", POSITIVE),
        (r"her[-\s]?2\s*[:\-]?\s*negativo\b", NEGATIVE),
        (r"her[-\s]?2.*?s?core\s*[:\-]?\s*([0-3]\+?)", SCORE_LABELS),
        (r"\bher[-]?2\s*[:\-]?\s*([0-3]\+)\b", BARE_SCORE_LABELS),
    ),
    3: (
        (r"her[-\s]?2.{0,60}?s?core\s*[:\-]?\s*([0-3]\+?)", SCORE_LABELS),
        (r"her[-\s]?2.{0,60}?[:\-]?\s*positivo\b", POSITIVE),
        (r"her[-\s]?2.{0,60}?[:\-]?\s*negativo\b", NEGATIVE),
        (r"\bher[-]?2\s*[:\-]?\s*([0-3]\+)\b", BARE_SCORE_LABELS),
    ),
}
CK56_RULES = {
    1: (
        (r"ck5\s*\/\s*6.*?[:\-]?\s*positivo", POSITIVE),
        (r"ck5\s*\/\s*6.*?[:\-]?\s*negativo", NEGATIVE),
        (r"\bck5\s*\/\s*6\s*[\+]\b", POSITIVE),
        (r"\bck5\s*\/\s*6\s*[\-]\b", NEGATIVE),
    ),
    2: (
        (r"\bck5\s*\/\s*6\s*[\+]\b", POSITIVE),
        (r"\bck5\s*\/\s*6\s*[\-]\b", NEGATIVE),
        (r"ck5\s*\/\s*6.{0,70}?(\bnegativo\b|\bpositivo\b)",
         {"positivo": POSITIVE, "negativo": NEGATIVE}),
    ),
}
KI67_PERCENT = {
    1: r"ki[-\s]?67.*?[:\-]?\s*(\d{1,3}(?:\.\d+)?)\s*%",
    2: r"ki[-\s]?67.{0,100}?[:\-]?\s*(\d{1,3}(?:[.,]\d+)?)\s*%",
}

# Pattern versions each source group is evaluated with
RULE_VERSIONS = {
    "F": {"mitotic": 2, "er": 2, "pr": 2, "her2": 2, "ki67": 2, "ck56": 2},
    "P": {"mitotic": 1, "er": 1, "pr": 1, "her2": 1, "ki67": 1, "ck56": 1},
}

# Marker mentions (strict) and the looser set counted together
MARKERS = {
    "estrogenio": r"\b(?:receptor\s+de\s+estr[oó]g(?:[eê]nio|eno))\b",
    "progesterona": r"\b(?:receptor\s+de\s+progesterona)\b",
    "her2": r"\bher2\b",
    "ck5_6": r"\bck5\s*\/\s*6\b",
    "ki67": r"\bki[-\s]?67\b",
}
MARKERS_LOOSE = {
    "estrogenio": r"\b(?:receptor\s+de\s+estr[oó]g(?:[eê]nio|eno)|er)\b",
    "progesterona": r"\bprogesterona\b",
    "her2": r"\bher2\b",
    "ck5_6": r"\bck5\s*\/\s*6\b",
    "ki67": r"\bki[-\s]?67\b",
}
CONTEXT_CHARS = 100

# Answer fields
PATHOLOGY_FIELDS = ("descritores_malignidade", "grau_histologico", "grau_nuclear",
                    "formacao_tubulos", "indice_mitotico", "tipo_histologico")
IHC_FIELDS = ("receptor_estrogeno", "receptor_progesterona", "status_her2",
              "ki67_percentual", "status_ck5_6")

# Molecular subtypes
SUBTYPES = {
    "luminal_a": "Luminal A",
    "luminal_b": "Luminal B",
    "luminal_her2": "Luminal com HER2 Positivo",
    "her2": "HER-2 Superexpresso",
    "triple_negative": "Triplo Negativo",
    "undefined": "Indefinido",
}
