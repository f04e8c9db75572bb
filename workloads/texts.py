"""Invented report sentences and answers, one per branch of an extraction.

No backslashes or single quotes: the same literals are used in two SQL dialects.
"""

NL = "\n"

CATEGORY_TEXTS = (
    "Conclusão: BI-RADS®: 0.",
    "Conclusão: BI-RADS 1.",
    "Impressão: categoria II.",
    "BI-RADS 3",
    "Avaliação: BI-RADS 4A.",
    "BI-RADS 2. Observação. BI-RADS 3.",
    "Categoria IV e BI-RADS 5.",
    "BI-RADS 4A. Categoria IV",
    "Sem achados.",
    f"linha um{NL}BI-RADS 2",
    "Categoria 10A",
    "CAT. VI",
    "Opinião: categorio 3 revisto. Categora II.",
)

BIOPSY_TEXTS = (
    "Topografia: MAMA direita, CARCINOMA invasivo.",
    "Topografia: mama. Carcinoma ductal e carcinoma lobular.",
    "CARCINOMA presente. Topografia: MAMA.",
    f"Topografia: MAMA{NL}CARCINOMA",
    "Topografia: pele. Sem CARCINOMA.",
    "Fragmentos sem atipia.",
    "Topografia: PELE, MAMA, carcinoma in situ. Topografia: MAMA.",
    f"Carcinoma. Topografia: MAMA.{NL}Topografia: MAMA com CARCINOMA.",
    "topografia: mama esquerda, sem sinais. Nota. Descarta-se carcinoma.",
    "MAMA Topografia: CARCINOMA",
    f"Linha inicial.{NL}Topografia: MAMA; CarcinomA; fim.{NL}Topografia: MAMA CARCINOMA",
)

PATHOLOGY_TEXTS = (
    "Topografia: mama. Carcinoma de mama ductal invasivo. Grau histológico: 2. Grau nuclear: 3. Formação de túbulos: 3. Índice mitótico: 11 mitoses / mm2.",
    "Topografia: mama. Carcinoma de mama ductal in situ (CDIS). Grau nuclear - 2.",
    "TOPOGRAFIA: MAMA. CARCINOMA DE MAMA LOBULAR INVASIVO. GRAU HISTOLÓGICO 1. FORMACAO DE TUBULOS 2. INDICE MITOTICO 3/10 MM2.",
    "Topografia: mama. Carcinoma de mama lobular, CLI. Grau histologico - 3. Mitótico: 2 mm2.",
    "Topografia: pele. Tumor maligno, metástase de sarcoma.",
    "Topografia: mama. Carcinoma de mama metaplásico, maligna, invasor.",
    "Topografia: mama. Carcinoma de mama cistico adenoide. Carcinomatose ausente.",
    "Topografia: mama. Carcinoma de mama mucinoso. Índice mitótico: 1 mitose / mm2. Grau nuclear sem nota.",
    "Fragmento metastático. CDI e cdis. Grau histológico",
    "Topografia: mama. Sem malignidade. Lesões benignas.",
    "Topografia: mama. Carcinoma de mama misto (ductal e lobular) invasivo. Grau histológico: 2. Índice mitótico 4 / 10 mm2.",
    "Topografia: mama. Carcinoma de mama tubular e carcinoma de mama medular.",
    "Topografia: mama. Carcinoma de mama papilífero micropapilar. Formação de túbulos: 1. Grau nuclear:1.",
)
# What a model could answer for each text above: some right, some not.
PATHOLOGY_ANSWERS = (
    '{"descritores_malignidade": ["invasivo", "carcinoma"], "grau_histologico": "2", "grau_nuclear": "3", "formacao_tubulos": "3", "indice_mitotico": "11", "tipo_histologico": "carcinoma de mama ductal invasivo"}',
    '{"descritores_malignidade": ["carcinoma", "cdis"], "grau_histologico": "NÃO INFORMADO", "grau_nuclear": "2", "formacao_tubulos": "NÃO INFORMADO", "indice_mitotico": "NÃO INFORMADO", "tipo_histologico": "carcinoma de mama ductal in situ"}',
    '{"descritores_malignidade": ["carcinoma", "invasivo"], "grau_histologico": "1", "grau_nuclear": "nao informado", "formacao_tubulos": "2", "indice_mitotico": "3", "tipo_histologico": "carcinoma de mama lobular invasivo"}',
    '{"descritores_malignidade": ["carcinoma"], "grau_histologico": 3, "grau_nuclear": null, "indice_mitotico": "2", "tipo_histologico": "carcinoma de mama lobular"}',
    '{"descritores_malignidade": ["maligno", "sarcoma", "metástase"], "grau_histologico": "NÃO INFORMADO", "grau_nuclear": "NÃO INFORMADO", "formacao_tubulos": "NÃO INFORMADO", "indice_mitotico": "NÃO INFORMADO", "tipo_histologico": "NÃO INFORMADO"}',
    '{"descritores_malignidade": ["carcinoma", "invasor", "maligna"], "tipo_histologico": "carcinoma de mama metaplásico"}',
    '{"descritores_malignidade": ["carcinoma", "carcinoma"], "grau_histologico": "dois", "tipo_histologico": "NÃO INFORMADO"}',
    '{"descritores_malignidade": [], "grau_nuclear": "1", "indice_mitotico": "1", "tipo_histologico": "carcinoma de mama mucinoso"}',
    '{"descritores_malignidade": ["cdi", "cdis", "metastático"], "grau_histologico": "NÃO INFORMADO"}',
    '{"descritores_malignidade": null, "grau_histologico": "NÃO INFORMADO", "grau_nuclear": "NÃO INFORMADO", "formacao_tubulos": "NÃO INFORMADO", "indice_mitotico": "NÃO INFORMADO", "tipo_histologico": "NÃO INFORMADO"}',
    '{"descritores_malignidade": ["invasivo", "carcinoma"], "grau_histologico": "2", "indice_mitotico": "4", "tipo_histologico": "carcinoma de mama misto (ductal e lobular) invasivo"}',
    '{"descritores_malignidade": ["carcinoma"], "tipo_histologico": "carcinoma de mama tubular"}',
    '{"descritores_malignidade": ["carcinoma"], "grau_nuclear": "1", "formacao_tubulos": "1", "tipo_histologico": "carcinoma de mama micropapilar"}',
)

# {p} is replaced by a number derived from the report key.
IHC_TEXTS = (
    "Carcinoma de mama. RECEPTOR DE ESTRÓGENO - POSITIVO. RECEPTOR DE PROGESTERONA - POSITIVO. HER-2 - ESCORE 0. KI67 - POSITIVO EM {p}% DAS CÉLULAS. CK5/6 - NEGATIVO.",
    "Carcinoma de mama. Receptor de estrogênio: negativo. Receptor de progesterona: negativo. HER-2 - ESCORE 3+ . Ki-67: {p},5 %. CK5/6 - POSITIVO.",
    "Carcinoma de mama. Receptor de estrogeno negativo. Receptor de progesterona - escore 1+ (negativo). HER2 - negativo. Ki 67 {p}.5%. CK5/6 sem status.",
    "Mama: carcinoma. RECEPTOR DE PROGESTERONA - NEGATIVO (CONTROLE INTERNO POSITIVO). HER-2 ESCORE 2+. KI67 em 20-{p}% das células. ck5 / 6: perda de expressão.",
    "Carcinoma, mama. ER+focal e PR-total. HER2 3+forte. CK5/6+focal.",
    "Carcinoma, mama. ER-baixo e PR+alto. HER2 1+fraco. CK5/6-total.",
    "Carcinoma, mama. ER+ e PR+ . HER2 2+ . CK5/6+ .",
    "Mama com carcinoma. HER-2: positivo. Receptor de estrógeno: positivo. Receptor de estrógeno: negativo em outra amostra. Ki-67 sem valor.",
    "Mama. Carcinoma. RECEPTOR DE PROGESTERONA em células neoplásicas do componente visto: POSITIVO. HER 2 score 1+. KI67 {p}%",
    "Mama. Carcinoma. RECEPTOR DE PROGESTERONA em células neoplásicas do componente visto na lâmina A: POSITIVO. HER2 em amostra do bloco dois sem outra nota: escore 3+. KI67 - células neoplásicas positivas de modo difuso em toda a amostra enviada ao laboratório central, cerca de {p}%.",
    "Mama. Carcinoma. CK5/6 nas células do componente in situ e nas células invasivas: NEGATIVO; controle POSITIVO. HER-2 (CERBB2) com interpretação distante. HER2 status negativo.",
    f"Sem carcinoma em mama.{NL}Receptor de estrogenio{NL}positivo{NL}HER-2{NL}escore 3+{NL}KI67{NL}{{p}}%",
    "Painel não realizado.",
    "Mama. Carcinoma. HER2 - escore 2. HER2 - escore 3+. CK5/6 negativo. CK5/6 positivo. Ki67 {p} a 90%.",
    "Mama. Carcinoma. Receptor de estrogegenio - positivo. Receptor de estrogêgenio: negativo. Receptor de progesterona* negativo. Ki67: 5% e Ki67: {p}%.",
)
IHC_ANSWERS = (
    '{"receptor_estrogeno": "POSITIVO", "receptor_progesterona": "POSITIVO", "status_her2": "NEGATIVO", "ki67_percentual": "{p}", "status_ck5_6": "NEGATIVO"}',
    '{"receptor_estrogeno": "NEGATIVO", "receptor_progesterona": "NEGATIVO", "status_her2": "POSITIVO", "ki67_percentual": "{p}.5", "status_ck5_6": "POSITIVO"}',
    '{"receptor_estrogeno": "NEGATIVO", "receptor_progesterona": "NEGATIVO", "status_her2": "NEGATIVO", "ki67_percentual": "{p}.5", "status_ck5_6": "NÃO INFORMADO"}',
    '{"receptor_estrogeno": "NÃO INFORMADO", "receptor_progesterona": "NEGATIVO", "status_her2": "INCONCLUSIVO", "ki67_percentual": "20-30", "status_ck5_6": "NÃO INFORMADO"}',
    '{"receptor_estrogeno": "POSITIVO", "receptor_progesterona": "NEGATIVO", "status_her2": "POSITIVO", "ki67_percentual": "NÃO INFORMADO", "status_ck5_6": "POSITIVO"}',
    '{"receptor_estrogeno": "NEGATIVO", "receptor_progesterona": "POSITIVO", "status_her2": "NEGATIVO", "ki67_percentual": null, "status_ck5_6": "NEGATIVO"}',
    '{"receptor_estrogeno": "NÃO INFORMADO", "receptor_progesterona": "NÃO INFORMADO", "status_her2": "NÃO INFORMADO", "ki67_percentual": "0", "status_ck5_6": "NÃO INFORMADO"}',
    '{"receptor_estrogeno": "POSITIVO", "status_her2": "POSITIVO", "ki67_percentual": "0"}',
    '{"receptor_estrogeno": "NÃO INFORMADO", "receptor_progesterona": "POSITIVO", "status_her2": "NEGATIVO", "ki67_percentual": {p}, "status_ck5_6": "NÃO INFORMADO"}',
    '{"receptor_estrogeno": "NÃO INFORMADO", "receptor_progesterona": "POSITIVO", "status_her2": "POSITIVO", "ki67_percentual": "{p}", "status_ck5_6": "NÃO INFORMADO"}',
    '{"receptor_estrogeno": "NÃO INFORMADO", "receptor_progesterona": "NÃO INFORMADO", "status_her2": "NEGATIVO", "ki67_percentual": "13.9", "status_ck5_6": "NEGATIVO"}',
    '{"receptor_estrogeno": "POSITIVO", "receptor_progesterona": "NÃO INFORMADO", "status_her2": "NEGATIVO", "ki67_percentual": "14", "status_ck5_6": "NÃO INFORMADO"}',
    '{}',
    '{"receptor_estrogeno": null, "receptor_progesterona": null, "status_her2": null, "ki67_percentual": "90", "status_ck5_6": "NEGATIVO"}',
    '{"receptor_estrogeno": "NÃO INFORMADO", "receptor_progesterona": "NEGATIVO", "status_her2": "NÃO INFORMADO", "ki67_percentual": "5", "status_ck5_6": "NÃO INFORMADO"}',
)
_SAMPLE = ('{"amostra_id": "%s", "receptor_estrogeno": "%s", "receptor_progesterona": "%s", '
           '"status_her2": "%s", "ki67_percentual": "{p}", "status_ck5_6": "NEGATIVO"}')
SAMPLE_ANSWERS = (
    '{"amostras": [' + _SAMPLE % ("A", "POSITIVO", "POSITIVO", "NEGATIVO") + "]}",
    '{"amostras": [' + _SAMPLE % ("A", "POSITIVO", "NEGATIVO", "POSITIVO") + ", "
    + _SAMPLE % ("B", "NEGATIVO", "NEGATIVO", "NEGATIVO") + "]}",
    '{"amostras": [' + _SAMPLE % ("A", "NEGATIVO", "NEGATIVO", "POSITIVO") + ", "
    + _SAMPLE % ("B", "NEGATIVO", "NEGATIVO", "INCONCLUSIVO") + ", "
    + _SAMPLE % ("C", "NEGATIVO", "POSITIVO", "NEGATIVO") + "]}",
    '{"amostras": []}',
    '{"amostras": null}',
)
