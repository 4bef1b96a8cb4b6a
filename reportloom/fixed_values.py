"""Wire formats, word lists and patterns that results depend on."""

# --- fixed values: replacement token per label -------------------------------------------
LABEL_TOKENS = {
    "NAME": "[NAME]",
    "DATE": "[DATE]",
    "DOB": "[DATE]",
    "STUDY_DATE": "[DATE]",
    "PHONE": "[PHONE]",
    "EMAIL": "[EMAIL]",
    "ID": "[ID]",
    "POLICY": "[ID]",
    "SNILS": "[ID]",
    "ADDRESS": "[ADDRESS]",
    "ORG": "[ORG]",
    "LOCATION": "[ADDRESS]",
    "COMBO": "[PII_COMBO]",
}

# --- fixed values: personal-data patterns, in the order that decides ties -----------------
PII_PATTERNS = [
    ("EMAIL", r"[a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+\.[a-zA-Z]{2,}"),
    ("PHONE", r"(?:(?:\+\d{1,3}[\s-]?)?(?:\(\d{2,4}\)[\s-]?)?|0)?\d{3,4}[\s-]?\d{2,3}[\s-]?\d{2,3}"),
    (
        "DATE",
        r"\b(?:\d{1,2}[\.\-/]\d{1,2}[\.\-/]\d{2,4}|\d{4}-\d{1,2}-\d{1,2}"
        r"|(?:янв|фев|мар|апр|май|июн|июл|авг|сен|окт|ноя|дек)[а-я]*\s+\d{1,2},?\s*\d{4})\b",
    ),
    ("DOB", r"(Дата\s+рождения|дата\s+рожд\.?)[^\n:;\d]{0,5}[:\s]*\d{1,2}[\.\-/]\d{1,2}[\.\-/]\d{2,4}"),
    ("POLICY", r"(полис|полиса|полис ОМС|№ полиса)[:\s]*[A-Z0-9\-\s]{4,30}"),
    ("SNILS", r"\b\d{3}[- ]?\d{3}[- ]?\d{3}[- ]?\d{2}\b"),
    ("NAME", r"\b[А-ЯЁ][а-яё]+(?:\s+[А-ЯЁ]\.[А-ЯЁ]\.|\s+[А-ЯЁ]\.\s+[А-ЯЁ]\.)\b"),
    ("ADDRESS", r"\b(?:ул\.|улица|проспект|просп\.|пл\.|площадь|пер\.|перевулок|г\.|город)\s+[\w\d\-\.]+"),
    ("ORG", r"\b(?:ФГБУ|ООО|ЗАО|ОАО|Больница|Клиника|Поликлиника|Лаборатория)\b[\w\s,\-\.]*"),
    ("LOCATION", r"\b(город|г\.|г\s)[\s\S]{1,40}?\b[А-ЯЁ][а-яё]+"),
]

# Opt-in replacement for NAME that also accepts the initials at a word end.
NAME_STRICT = r"\b[А-ЯЁ][а-яё]+(?:\s+[А-ЯЁ]\.[А-ЯЁ]\.|\s+[А-ЯЁ]\.\s+[А-ЯЁ]\.)(?!\w)"

# --- fixed values: modality words ----------------------------------------------------------
MR, CT = "МРТ", "КТ"
FOLDER_MODALITY = (["мр", "mrt", "mri", "mr_"], ["кт", "ct", "kt_"])
TEXT_MODALITY = (["мр", "mri", "мрт"], ["кт", "ct"])

# --- fixed values: organ abbreviations -----------------------------------------------------
ORGAN_NAMES = {
    "бп": "брюшная полость",
    "ВНЧС": "височно-нижнечелюстной сустав",
    "гм": "головной мозг",
    "мж": "молочная железа",
    "мт": "малый таз",
}

# --- fixed values: names of the per-folder result tables -----------------------------------
RESULT_FILES = ["processed_result.csv", "processed_results.csv"]
RESULT_COLUMNS = ["finding", "file_name", "result"]
REPORT_EXTENSIONS = ["txt", "pdf", "doc", "docx", "rtf"]

# --- fixed values: texts read as missing in an inferred CSV ----------------------------------
NA_TEXTS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]

# --- fixed values: prompt wordings; {name} marks a column ------------------------------------
PROMPTS = {
    ("simple", "text"): (
        "Ты — медицинская LLM. По следующей находке сформируй краткое заключение:\n\n"
        "Орган: {organ}\nНаходка: {finding}\n\nОтвет:"
    ),
    ("simple", "json"): (
        "Ты — медицинская LLM. По следующей находке сформируй краткое заключение. "
        "Ответ верни в формате JSON с ключом 'result'.\n\n"
        "Орган: {organ}\nНаходка: {finding}\n\nФормат ответа:\n{{'result': '...'}}"
    ),
    ("medium", "text"): (
        "Ты — нейросеть, помогающая радиологу писать заключения. "
        "Исследование: {modality}. Орган: {organ}. Находка: {finding}\n\n"
        "Сформируй итоговое заключение:"
    ),
    ("medium", "json"): (
        "Ты — нейросеть, помогающая радиологу писать заключения. "
        "Тебе дана находка по исследованию {modality} для органа {organ}. "
        "Сформируй полное, логически связанное заключение. "
        "Ответ верни в формате JSON с ключом 'result'.\n\n"
        "Находка: {finding}\n\nФормат:\n{{'result': '...'}}"
    ),
    ("cot", "text"): (
        "Ты — опытный радиолог. Проанализируй находку и рассуждай шаг за шагом перед ответом.\n\n"
        "Орган: {organ}\nНаходка: {finding}\n\nПошаговое рассуждение и итоговое заключение:"
    ),
    ("cot", "json"): (
        "Ты — опытный радиолог. Проанализируй следующую находку, рассуждай шаг за шагом, "
        "а затем сформулируй финальное заключение. "
        "Ответ верни в JSON с ключом 'reasoning' и 'result'.\n\n"
        "Орган: {organ}\nНаходка: {finding}\n\nФормат:\n{{'reasoning': '...', 'result': '...'}}"
    ),
}

EXAMPLES_HEAD = "Примеры:"
EXAMPLE = "Пример {number}:\nНаходка: {finding}\nЗаключение: {result}\n"
NO_EXAMPLES = "Примеры: (нет подходящих примеров)"

_ANSWER_RULES = (
    "Требования: has_finding=true/false; organ — анатомическая область; "
    "modality — только 'МРТ' или 'КТ'."
)
# key: (step-by-step reasoning asked for, JSON answer asked for)
FEW_SHOT_PROMPTS = {
    (True, True): (
        "Ты — опытный радиолог. \n"
        "Проанализируй находку и рассуждай шаг за шагом перед формированием заключения. \n"
        "Используй приведённые примеры как ориентиры по стилю и структуре.\n\n"
        "{examples}\n\nЗадача:\nОрган: {organ}\nНаходка: {finding}\n\n"
        "Ответ верни строго в формате JSON со следующими полями:\n"
        '{{\n  "reasoning": "...",\n  "result": "...",\n  "has_finding": true,  \n'
        '  "organ": "...",      \n  "modality": "МРТ|КТ" \n}}\n\n' + _ANSWER_RULES
    ),
    (True, False): (
        "Ты — опытный радиолог. Рассуждай шаг за шагом и сформулируй итоговое заключение.\n\n"
        "{examples}\n\nОрган: {organ}\nНаходка: {finding}\n\n"
        "Пошаговое рассуждение и итоговое заключение:"
    ),
    (False, True): (
        "Ты — медицинская LLM. Сформируй краткое заключение по находке.\n\n"
        "{examples}\n\nОрган: {organ}\nНаходка: {finding}\n\n"
        "Ответ верни строго в формате JSON со следующими полями:\n"
        '{{\n  "result": "...",\n  "has_finding": true,\n'
        '  "organ": "...",\n  "modality": "МРТ|КТ"\n}}\n\n' + _ANSWER_RULES
    ),
    (False, False): (
        "Ты — медицинская LLM. Сформируй краткое заключение по находке.\n\n"
        "{examples}\n\nОрган: {organ}\nНаходка: {finding}\n\nОтвет:"
    ),
}

# --- request wordings of our own; only the JSON field names are a fixed format ----------------
REDACTION_REQUEST = (
    "Найди в тексте персональные данные и замени каждое вхождение одним из токенов: "
    "[NAME], [DATE], [ADDRESS], [PHONE], [POLICY], [SNILS], [EMAIL]. "
    "Названия больниц и населённых пунктов тоже заменяй. "
    'Верни JSON {{"text": "...", "spans": [{{"start": 0, "end": 0, "label": "...", "text": "..."}}]}}, '
    "где start и end — позиции в исходном тексте. Если скрывать нечего, верни исходный текст "
    "и пустой список spans.\n\nТекст:\n\n{chunk}\n"
)
EXTRACTION_REQUEST = (
    "Из протокола исследования выдели главную находку (одна-две строки) и дословный текст заключения. "
    'Ответь одним JSON-объектом без разметки: {{"finding": "...", "conclusion": "..."}}. '
    "Если находок нет, напиши «нет находок»; если заключения нет — «нет заключения».\n\n"
    "Протокол:\n{report}"
)

# --- fixed values: schema sent with a structured request --------------------------------------
ANSWER_FORMAT = {
    "type": "json_schema",
    "json_schema": {
        "name": "Response",
        "schema": {
            "type": "object",
            "properties": {
                "result": {"type": "string"},
                "has_finding": {"type": ["boolean", "null"]},
                "organ": {"type": ["string", "null"]},
                "modality": {"type": ["string", "null"]},
            },
            "required": ["result"],
            "additionalProperties": False,
        },
        "strict": True,
    },
}

# --- fixed values: international scoring tokenisation, applied in this order -------------------
# literal replacements, then (pattern, replacement) on the text padded with one space at each end;
# the first class is published with the blank in it, which only adds blanks to blanks
SCORE_LITERALS = [
    ("<skipped>", ""), ("-\n", ""), ("\n", " "), ("&quot;", '"'), ("&amp;", "&"), ("&lt;", "<"), ("&gt;", ">"),
]
SCORE_RULES = [
    (r"([\{-\~\[-\` -\&\(-\+\:-\@\/])", r" \1 "),
    (r"([^0-9])([\.,])", r"\1 \2 "),
    (r"([\.,])([^0-9])", r" \1 \2"),
    (r"([0-9])(-)", r"\1 \2 "),
]

# --- fixed values: suffix rules of the 1980 stemmer, with its later additions -------------------
STEM_IRREGULAR = {
    "skies": "sky", "sky": "sky", "dying": "die", "lying": "lie", "tying": "tie", "news": "news",
    "innings": "inning", "inning": "inning", "outings": "outing", "outing": "outing", "cannings": "canning",
    "canning": "canning", "howe": "howe", "proceed": "proceed", "exceed": "exceed", "succeed": "succeed",
}
STEM_STEP_2 = [
    ("ational", "ate"), ("tional", "tion"), ("enci", "ence"), ("anci", "ance"), ("izer", "ize"), ("bli", "ble"),
    ("alli", "al"), ("entli", "ent"), ("eli", "e"), ("ousli", "ous"), ("ization", "ize"), ("ation", "ate"),
    ("ator", "ate"), ("alism", "al"), ("iveness", "ive"), ("fulness", "ful"), ("ousness", "ous"),
    ("aliti", "al"), ("iviti", "ive"), ("biliti", "ble"), ("fulli", "ful"), ("logi", "log"),
]
STEM_STEP_3 = [
    ("icate", "ic"), ("ative", ""), ("alize", "al"), ("iciti", "ic"), ("ical", "ic"), ("ful", ""), ("ness", ""),
]
STEM_STEP_4 = [
    "al", "ance", "ence", "er", "ic", "able", "ible", "ant", "ement", "ment", "ent", "ion", "ou", "ism", "ate",
    "iti", "ous", "ive", "ize",
]

# --- fixed values: weights of the alignment score ------------------------------------------------
METEOR_ALPHA, METEOR_BETA, METEOR_GAMMA = 0.9, 3.0, 0.5
