"""Word lists, lookup tables, constants, patterns and text templates.

Results depend on these exact values. They are stated here as plain data, in
their natural order and in one place; no logic lives in this module.
"""

# --- fixed values: defaults and markers -------------------------------------
DEFAULT_TITLE = "Kein Titel"
DEFAULT_POSITION = "Normaler Angestellter"
DEFAULT_TIME_MODEL = "Vollzeit"
DEFAULT_EMPLOYMENT = "befristet"
PERMANENT_EMPLOYMENT = "Feste Anstellung"
DEFAULT_SIZE = "Keine Angaben"
UNKNOWN_PORTAL = "Unknown"
UNKNOWN_PLACE = "Unknown"
UNRESOLVED_PLACE = "Unbekannt"
NATION_WIDE = "bundesweit"
NATION_WIDE_COUNTRY = "Germany"
HOME_COUNTRY = "Germany"
HOME_COUNTRY_LABEL = "Deutschland"
NOT_FOUND_BENEFIT = "nicht gefunden"
REMOTE_PHRASE = "homeoffice möglich"
DROPPED_CATEGORY = "non_incentive"
REMOTE_CATEGORY = "Homeoffice"
OTHER_BRANCH = "Andere"
COMPANY_LIST = "company"
COMPANY_INFO_LIST = "CompanyInfo"
BENEFITS_LIST = "content/benefits"

# --- fixed values: phrase classification ------------------------------------
DIRECT_WEIGHT = 0.8
CONTEXT_WEIGHT = 0.2
THRESHOLD = 0.45
TOP_K = 5

# --- fixed values: company size buckets, (lower, upper] ---------------------
SIZE_BUCKETS = [
    (0, 10, "0-10"),
    (10, 50, "11-50"),
    (50, 250, "51-250"),
    (250, 500, "251-500"),
    (500, 1000, "501-1000"),
    (1000, 2500, "1001-2500"),
    (2500, 10000, "2501-10000"),
    (10000, None, "10000+"),
]

# --- fixed values: synonyms -------------------------------------------------
# Effective lists: some entries run two wordings together, so that the plain
# wording ("full time", "part-time", "40 h") never matches. Kept on purpose.
TIME_MODELS = {
    "Vollzeit": [
        "vollzeit", "vollzeitstelle", "ganztags", "40 stunden", "vollbeschäftigung", "vollzeitjob", "vollzeitarbeit",
        "voll- und teilzeit", "voll und teilzeit", "voll- oder teilzeit", "voll oder teilzeit",
        "voll- & teilzeit", "voll & teilzeit",
        "full- and part time", "full and part timefull- & part time", "full & part timefull time",
        "full-timefull or part time", "full- or part time40 h",
    ],
    "Teilzeit": [
        "teilzeit", "teilzeitstelle", "halbtags", "20 stunden", "teilbeschäftigung", "teilzeitjob", "teilzeitarbeit",
        "reduzierte stunden",
        "voll- und teilzeit", "voll und teilzeit", "voll- oder teilzeit", "voll oder teilzeit",
        "voll- & teilzeit", "voll & teilzeit",
        "full- and part time", "full and part timefull- & part time", "full & part timepart time",
        "part-timefull or part time", "full- or part time20 h",
    ],
}
# The lists as they read when every wording stands alone.
TIME_MODELS_SEPARATED = {
    "Vollzeit": [
        "vollzeit", "vollzeitstelle", "ganztags", "40 stunden", "vollbeschäftigung", "vollzeitjob", "vollzeitarbeit",
        "voll- und teilzeit", "voll und teilzeit", "voll- oder teilzeit", "voll oder teilzeit",
        "voll- & teilzeit", "voll & teilzeit",
        "full- and part time", "full and part time", "full- & part time", "full & part time", "full time", "full-time",
        "full or part time", "full- or part time", "40 h",
    ],
    "Teilzeit": [
        "teilzeit", "teilzeitstelle", "halbtags", "20 stunden", "teilbeschäftigung", "teilzeitjob", "teilzeitarbeit",
        "reduzierte stunden",
        "voll- und teilzeit", "voll und teilzeit", "voll- oder teilzeit", "voll oder teilzeit",
        "voll- & teilzeit", "voll & teilzeit",
        "full- and part time", "full and part time", "full- & part time", "full & part time", "part time", "part-time",
        "full or part time", "full- or part time", "20 h",
    ],
}
POSITIONS = {
    "Praktikant": ["praktikum", "praktikant", "trainee", "praktikantin", "volontär", "internship"],
    "Werkstudent": [
        "werkstudent", "werkstudentin", "studentische hilfskraft",
        "student assistant", "student worker", "working student",
    ],
}
# Only the permanent list is ever consulted; the fixed-term list is not used.
PERMANENT_SYNONYMS = [
    "unbefristet", "dauerhaft", "festanstellung", "festangestellt", "unbefristeter vertrag", "dauerstelle",
    "festvertrag", "Feste Anstellung",
    "permanent", "full-time", "regular employment", "indefinite contract",
]

# --- fixed values: state names ----------------------------------------------
STATE_NAMES = {
    "Bavaria": "Bayern",
    "Lower Saxony": "Niedersachsen",
    "Baden-Württemberg": "Baden-Württemberg",
    "Rhineland-Palatinate": "Rheinland-Pfalz",
    "Saxony": "Sachsen",
    "Thuringia": "Thüringen",
    "Hesse": "Hessen",
    "North Rhine-Westphalia": "Nordrhein-Westfalen",
    "Saxony-Anhalt": "Sachsen-Anhalt",
    "Brandenburg": "Brandenburg",
    "Mecklenburg-Western Pomerania": "Mecklenburg-Vorpommern",
    "Hamburg": "Hamburg",
    "Schleswig-Holstein": "Schleswig-Holstein",
    "Saarland": "Saarland",
    "Bremen": "Bremen",
    "Berlin": "Berlin",
    "Mecklenburg-Vorpommern": "Mecklenburg-Vorpommern",
    "North Rhine Westphalia": "Nordrhein-Westfalen",
    "Northrhine-Westphalia": "Nordrhein-Westfalen",
}

# --- fixed values: branches -------------------------------------------------
BRANCHES = [
    "IT", "Gesundheit", "Technik", "Bildung & Forschung", "Finanzen", "Recht", "Marketing & Medien",
    "Handel & E-Commerce", "Bau & Handwerk", "Logistik", "Öffentlicher Dienst", "Andere",
]

# --- fixed values: benefit categories with examples and context -------------
# (category, examples, context); the order decides ties.
PROTOTYPES = [
    ("Gehalt_anhand_von_Tarifklassen",
     ["Gehalt nach Tarifvertrag", "Attraktive Bezahlung nach jeweiligem Tarifvertrag", "Tarifliche Vergütung",
      "Vergütung entsprechend Tarifvertrag"],
     "Compensation based on collective bargaining agreements or tariff classifications, providing standardized salary structures according to industry standards"),
    ("Überstundenvergütung",
     ["Bezahlte Überstunden", "Überstundenausgleich", "Vergütung von Mehrarbeit", "Nacht- und Feiertagszuschüsse"],
     "Compensation for work performed beyond regular working hours, including overtime pay, time off in lieu, or special allowances for night or holiday work"),
    ("Gehaltserhöhungen",
     ["Regelmäßige Gehaltsanpassungen", "Jährliche Gehaltssteigerungen", "Leistungsbezogene Gehaltserhöhungen",
      "Gehaltsentwicklung nach Karrierestufen"],
     "Regular or performance-based salary increases, including annual raises, systematic salary reviews, salary development frameworks, or regular feedback processes that impact compensation"),
    ("Aktienoptionen_Gewinnbeteiligung",
     ["Mitarbeiteraktien zu vergünstigten Konditionen", "Aktienbeteiligungsprogramm",
      "Gewinnbeteiligung am Unternehemenserfolg", "Optionen zum Erwerb von Unternehmensanteilen"],
     "Opportunities for employees to own company shares or stock options, including employee stock purchase plans, equity compensation, or discounted company shares"),
    ("Boni",
     ["Leistungsboni für persönliche Zielerreichung", "Verkaufsprovision bei Zielerreichung",
      "Erfolgsprämien für übertroffene Umsatzziele", "Projektabschlussprämien"],
     "Performance-based additional payments that reward individual or company achievements, typically variable in amount and directly tied to reaching specific targets or goals. Examples include sales commissions, performance bonuses, and profit-sharing payments."),
    ("Sonderzahlungen",
     ["Leistungsprämien und Bonuszahlungen", "Weihnachtsgeld und Urlaubsgeld",
      "Erfolgsbeteiligung am Unternehmensergebnis", "Sonderzuwendungen und Gratifikationen"],
     "One-time or regular additional payments beyond the normal salary that are typically tied to specific occasions, celebrations, or as general appreciation. These include holiday bonuses, vacation allowances, anniversary payments, and special situation payments like inflation compensation"),
    ("13. Gehalt",
     ["13. Monatsgehalt", "Zusätzliches volles Monatsgehalt", "13. Gehalt",
      "Jahressonderzahlung in Höhe eines vollen Monatsgehalts"],
     "An additional full month's salary paid once per year, separate from regular monthly payments and distinct from other bonuses or special payments"),
    ("Betriebliche_Altersvorsorge",
     ["Betriebliche Altersvorsorge", "Beiträge zur Altersvorsorge", "Arbeitgeberzuschuss zur Altersvorsorge",
      "Betriebsrente und Pensionsplan"],
     "Employer-sponsored retirement plans or pension schemes, including employer contributions to retirement funds, pension plans, or retirement insurance"),
    ("Flexible_Arbeitsmodelle",
     ["Flexible Arbeitszeiten", "Gleitzeit mit Kernarbeitszeiten", "Individuelle Arbeitszeitmodelle",
      "Vertrauensarbeitszeit", "individuell anpassbare Arbeitszeiten"],
     "Work arrangements that allow employees to vary when and how they work, including flexible start/end times, compressed work weeks, or trust-based working time"),
    ("Homeoffice",
     ["Homeoffice möglich", "Mobiles Arbeiten möglich", "Remote Work Option", "Hybrides Arbeitsmodell",
      "Homeoffice-Möglichkeit"],
     "Ability to work from home or remotely instead of commuting to an office location, including full remote work, hybrid models, or occasional work-from-home options"),
    ("Weiterbildung_und_Entwicklungsmöglichkeiten",
     ["Berufliche Weiterbildungsmöglichkeiten", "Fort- und Weiterbildungsangebote",
      "Persönliche und fachliche Entwicklung", "Coaching und Trainings", "Karriereprogramme"],
     "Opportunities for professional growth and skill development, including training programs, educational courses or career advancement paths"),
    ("Gesundheit_und_Wohlbefinden",
     ["Betriebliche Gesundheitsförderung", "Zuschuss zum Fitnessstudio",
      "Gesundheitsprogramme und Vorsorgeuntersuchungen", "Betriebssport", "Lauftreff"],
     "Programs and benefits focused on employee health and wellness, including fitness subsidies, wellness programs, company sports or joined sport groups"),
    ("Finanzielle_Vergünstigungen",
     ["Mitarbeiterrabatte auf Produkte", "Versicherungsleistungen", "Corporate Benefits und Vorteilsprogramme",
      "Finanzielle Zuschüsse und Sonderkonditionen", "Rabattangebote"],
     "Financial benefits beyond direct compensation, including employee discounts, insurance benefits, corporate perks, or financial subsidies"),
    ("Mobilitätsangebote",
     ["Firmenwagen", "Jobticket", "Fahrtkostenzuschuss", "Leasing", "Zuschuss zur Bahn- oder Autofahrt", "Job Rad"],
     "Benefits related to transportation and commuting, including company cars, public transport subsidies, bicycle leasing, or parking facilities"),
    ("Verpflegung",
     ["Bezuschusstes Betriebsrestaurant", "Kostenlose Getränke", "Essenszuschuss", "Obstkorb und Kaffeeflatrate",
      "Subventioniertes Essen"],
     "Food and beverage benefits provided in the workplace, including subsidized meals, free drinks, snacks, or meal allowances"),
    ("Arbeitsumfeld_Ausstattung",
     ["Moderne Büroausstattung", "Firmenlaptop und Smartphone", "Ergonomischer Arbeitsplatz",
      "Höhenverstellbare Schreibtische", "Firmenlaptop"],
     "Physical workplace environment and equipment provided to employees, including modern office furniture, technology, ergonomic equipment, or workspace design"),
    ("Zusätzliche_Urlaubstage",
     ["30 Tage Urlaubsanspruch", "Zusätzliche Urlaubstage über dem gesetzlichen Minimum",
      "Sonderurlaubstage für besondere Anlässe", "Sabbatical-Möglichkeit"],
     "Vacation days beyond the legal minimum requirement of 20 days, including extra holiday allowances, special occasion leave, sabbaticals, or extended time off"),
    ("Familien_Unterstützung",
     ["Betriebsnahe Kita und Eltern-Kind Büros", "Zuschuss zur Kinderbetreuung", "Familienfreundliche Arbeitszeiten",
      "Wiedereinstiegsprogramme nach Elternzeit", "Kitaplätze"],
     "Benefits that support employees with family responsibilities, including childcare assistance, parental leave, family-friendly work hours, parent-child offices, family services, emergency support, or specific allowances for family events"),
    ("Onboarding_und_Mentoring_Programme",
     ["Individuelle Einarbeitung und Onboarding", "Mentorenprogramm für neue Mitarbeiter", "Strukturierte Einarbeitung",
      "Patenschaftsprogramm", "Mentoring", "Onboardingtag und individuelles Einarbeitungsprogramm"],
     "Structured programs to help new employees integrate into the company, including orientation processes, mentoring relationships, buddy systems, or training periods"),
    ("Teamevents_Firmenfeiern",
     ["Teamevents", "Firmenfeiern und Betriebsausflüge", "Teambuilding-Aktivitäten",
      "Gemeinsame Mittagessen und Afterwork-Events", "Weihnachstfeiern und Sommerfeste", "Kulturevents"],
     "Social activities and events organized by the company to foster team spirit and company culture, including team outings, company celebrations, or social gatherings"),
    ("non_incentive",
     ["Gehalt anzeigen", "Teilzeit möglich", "Feste Anstellung",
      "Tolles Teamwork und ﬂache Hierarchien sichern kurze Kommunikationswege", "freundschaftliche Atmosphäre",
      "gemeinsame Zeit"],
     "Phrases indicating employment terms and tasks rather than benefits - salary disclosures, employment types (full/part-time), or work tasks that don't constitute additional incentives"),
]

# --- fixed values: result table columns, in order ---------------------------
RESULT_TEXT_COLUMNS = [
    "MongoDB_ID", "Job_URL", "Job_Titel", "Portal_Name", "Datum", "Stadt", "Bundesland", "Land", "Unternehmen",
    "Unternehmensgröße", "Zeitmodell", "Position", "Beschäftigungsart",
]
EXPERIENCE_COLUMN = "Berufserfahrung_vorausgesetzt"
BRANCH_COLUMN = "Kategorie"
FLAG_COLUMNS = [
    "Gehalt_anhand_von_Tarifklassen", "Überstundenvergütung", "Gehaltserhöhungen", "Aktienoptionen_Gewinnbeteiligung",
    "Boni", "Sonderzahlungen", "13. Gehalt", "Betriebliche_Altersvorsorge", "Flexible_Arbeitsmodelle", "Homeoffice",
    "Weiterbildung_und_Entwicklungsmöglichkeiten", "Gesundheit_und_Wohlbefinden", "Finanzielle_Vergünstigungen",
    "Mobilitätsangebote", "Verpflegung", "Arbeitsumfeld_Ausstattung", "Zusätzliche_Urlaubstage",
    "Familien_Unterstützung", "Onboarding_und_Mentoring_Programme", "Teamevents_Firmenfeiern",
]
UNMATCHED_COLUMN = "others"
RESULT_KEY = ["Job_URL", "Stadt", "Zeitmodell", "Position"]

# --- fixed values: columns compared by the evaluation -----------------------
# One flag is spelled with a slash there and so never meets its result column.
EVALUATED_FLAGS = [
    "Gehalt_anhand_von_Tarifklassen", "Überstundenvergütung", "Gehaltserhöhungen", "Aktienoptionen/Gewinnbeteiligung",
    "Boni", "Sonderzahlungen", "13._Gehalt", "Betriebliche_Altersvorsorge", "Flexible_Arbeitsmodelle", "Homeoffice",
    "Weiterbildung_und_Entwicklungsmöglichkeiten", "Gesundheit_und_Wohlbefinden", "Finanzielle_Vergünstigungen",
    "Mobilitätsangebote", "Verpflegung", "Arbeitsumfeld_Ausstattung", "Zusätzliche_Urlaubstage",
    "Familien_Unterstützung", "Onboarding_und_Mentoring_Programme", "Teamevents_Firmenfeiern",
]
EVALUATED_TEXTS = [
    "Job_Titel", "Portal_Name", "Datum", "Stadt", "Bundesland", "Land", "Zeitmodell", "Position", "Beschäftigungsart",
    "Berufserfahrung_vorausgesetzt",
]

# --- fixed values: prompt templates and generator settings ------------------
# Every line but the first is indented by the given number of blanks.
PROMPT_INDENT = 16
STRICT_PROMPT_INDENT = 8
EXPERIENCE_PROMPT = """You are a helpful assistant that extracts structured information from job descriptions.
Extract the following information from this text {value}:

For Experience Required:
- Return 1 if the job description explicitly mentions requiring professional experience
- Else return 0 
- Only return 0 or 1

EXAMPLE OUTPUT:
{
"Experience_Required": 1/0
}
Respond only with valid JSON. Do not write an introduction or summary.
"""
BENEFITS_PROMPT = """Antworte ausschließlich auf Deutsch.

Extrahiere alle Incentives/Benefitss aus folgender Stellenanzeige, soweit vorhanden:

{value}

REGELN:
1. Extrahiere nur Incentives/Benefits, die sich direkt auf die Incentives/Benefits, Vergütungen oder Zusatzleistungen für Mitarbeitende beziehen (z.B. finanzielle Anreize, flexible Arbeitsmodelle, Zusatzleistungen).
2. Schließe Aufgaben, Tätigkeiten, Anforderungen oder allgemeine Rollenbeschreibungen aus.
3. WICHTIG: Erfinde oder ergänze KEINE Incentives/Benefits – nur exakt das übernehmen, was im Text steht.
4. Vermeide Wiederholungen mit leicht abweichenden Formulierungen.
5. Übernimm die Incentives/Benefits wortwörtlich aus dem Text, NICHT umformulieren.
6. Gib keine allgemeinen Begriffe wie „finanzielle Anreize“, „flexible Arbeitszeitmodelle“ oder „zusätzliche Ausbildungsmöglichkeiten“ aus, wenn diese nicht wortwörtlich im Text stehen.


BEISPIELE:
Keine Incentives/Benefits (NICHT übernehmen!):
- "Herausfordernde Aufgaben" → Beschreibung der Tätigkeit
- "Wir entwickeln innovative Lösungen" → Allgemeine Aussage
- "Erfahrung mit Cloud-Technologien" → Anforderung
- "Verantwortung für IT-Projekte" → Aufgabenbeschreibung
- "Engagiertes Team" -> kein direkter Mitarbeitervorteil
- "Vollzeit/Teilzeit" -> Arbeitsmodelle, keine Incentives/Benefits
- "Gehalt" -> nur ein generischer Begriff ohne Aussage

Gib die Antwort ausschließlich als gültiges JSON-Objekt im folgenden Format zurück und nichts anderes:
{
    "benefits": [
        "benefit 1",
        "benefit 2",
        "benefit 3"
    ]
}

Keine Erklärungen, keine Beispiele, keine Einleitung, keine Zusammenfassung. Nur das JSON-Objekt im vorgegebenen Format!
"""
BRANCH_PROMPT = """Klassifiziere diesen Job-Titel in genau eine der folgenden Kategorien:
- IT: Softwareentwicklung, Programmierung, Cloud, Backend, DevOps, KI, Datenanalyse
- Gesundheit: Medizin, Pflege, Pharma, Krankenhauswesen, Gesundheitswesen
- Technik: Maschinenbau, Elektrotechnik, Produktion, Fertigung
- Bildung & Forschung: Lehre, Wissenschaft, Forschungsinstitute, Universitäten
- Finanzen: Bankwesen, Versicherungen, Buchhaltung, Steuerberatung
- Recht: Jura, Compliance, Notardienste, Rechtsberatung
- Marketing & Medien: Werbung, Journalismus, Social Media, Content Creation
- Handel & E-Commerce: Einzelhandel, Online-Handel, Vertrieb, E-Commerce
- Bau & Handwerk: Baugewerbe, Handwerksbetriebe, Sanierung
- Logistik: Transport, Lagerhaltung, Supply Chain Management
- Öffentlicher Dienst: Behörden, öffentliche Einrichtungen, Verwaltung
- Andere: Keine Übereinstimmung mit oben genannten

Job-Titel: {value} 

Regeln:
1. Wähle die spezifischste passende Kategorie
2. Bei Überschneidungen (z.B. IT in Gesundheitsbereich) primäre Branche wählen
3. Im Zweifelsfall "Andere"

Antworte NUR im JSON-Format: {"Kategorie": "<Kategorie>"} Schreibe keine Beispiele, Einleitungen oder Erklärungen."""
ENCODE_BATCH = 4
GENERATOR_SETTINGS = {
    "experience": {"max_new_tokens": 15, "do_sample": True, "temperature": 0.1, "repetition_penalty": 1.2},
    "benefits": {"max_new_tokens": 350, "do_sample": False, "repetition_penalty": 1.1},
    "branch": {
        "max_new_tokens": 20, "do_sample": True, "temperature": 0.1, "repetition_penalty": 1.1, "top_p": 0.95,
    },
}

# --- fixed values: patterns ---------------------------------------------------
FIRST_OBJECT = r"(?s)\{.*?\}"
WIDEST_OBJECT = r"(?s)\{.*\}"
PHRASE_ARRAY = r'(?sU)"benefits":\s*\[(.*?)(?:\]|}|$)'
BULLET = r"(?U)^(\s*[-*•]|\d+\.)\s*"
BULLET_MARKS = r"(?U)^[\s\-*•]+\s*"
ESCAPE = r"\\x[0-9A-Fa-f]{2}"
PORTAL_BY_WWW = r"www\.(.*?)\."
PORTAL_BY_COM = r"(?U)https?://(?:[\w-]+\.)*([\w-]+)\.com"
PLACE_SEPARATORS = r"[;/•]| und | oder "
PLACE_REMARK = r"(?iuU)\bbei\b[^\n]*"
PLACE_BRACKETS = r"\([^\n]*?\)"
PLACE_COMMA = r"(?U)\s*,\s*"
PLACE_SPLIT = r"(?U),\s*(?![^(]*\))"
