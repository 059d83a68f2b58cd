# Data that must be the same everywhere for results to agree.

# Source identifiers, as stored in the ``platform`` column.
PLATFORMS = ["jobs_ge", "cv_ge", "hr_ge", "ss_ge", "indeed", "linkedin", "glassdoor", "stack_overflow"]

# Other spellings a source has been recorded under -> identifier.
PLATFORM_SPELLINGS = {
    "Jobs.ge": "jobs_ge",
    "CV.ge": "cv_ge",
    "jobs.ss.ge": "ss_ge",
}

# Base addresses of the sources.
BASE_ADDRESS = {
    "jobs_ge": "https://jobs.ge",
    "cv_ge": "https://www.cv.ge",
    "ss_ge": "https://jobs.ss.ge",
}

# Month names.
GEORGIAN_MONTHS = [
    "იანვარი", "თებერვალი", "მარტი", "აპრილი", "მაისი", "ივნისი",
    "ივლისი", "აგვისტო", "სექტემბერი", "ოქტომბერი", "ნოემბერი", "დეკემბერი",
]
GEORGIAN_SHORT_MONTHS = [
    "იან", "თებ", "მარ", "აპრ", "მაი", "ივნ", "ივლ", "აგვ", "სექ", "ოქტ", "ნოე", "დეკ",
]
ENGLISH_MONTHS = [
    "January", "February", "March", "April", "May", "June",
    "July", "August", "September", "October", "November", "December",
]

# Section keywords, in order of precedence.
SECTION_KEYWORDS = {
    "requirements": ["მოთხოვნები", "აუცილებელი მოთხოვნები", "კვალიფიკაცია"],
    "responsibilities": ["მოვალეობები", "სამუშაო მოვალეობები", "ფუნქციები"],
    "conditions": ["პირობები", "სამუშაო პირობები", "შეთავაზება"],
    "benefits": ["უპირატესობები", "ბენეფიტები", "დამატებითი პირობები"],
}

# Salary words and signs.
LARI_SIGN = "₾"
# Shapes of a salary in running text, tried in order; N stands for the number.
SALARY_SHAPES = [r"ხელფასი[:\s]+(N)\s*ლარი", r"(N)\s*ლარი", r"ხელფასი[:\s]+(N)"]
PER_MONTH_WORD = "თვეში"
CURRENCY = "GEL"
PERIOD = "monthly"
CURRENCY_MARKS = r"\$|₾|ლარი"

# Marker words and icon file-name parts.
VIP_WORD = "ვიპ"
URGENT_WORD = "სასწრაფოდ"
REMOTE_WORD = "remote"
ICON_PARTS = {
    "is_expiring": "exp",
    "was_recently_updated": "upd",
    "has_salary_info": "salary",
    "is_new": "new",
    "is_in_region": "reg",
}

# Values one source never prints.
UNKNOWN_COMPANY = "Unknown Company"
DEFAULT_CITY = "თბილისი"

# Texts of the overview.
NOT_SPECIFIED = "Not specified"
REMOTE_LABEL = "Remote"
NON_REMOTE_LABEL = "Non-Remote"
NO_LOCATION = "Location not specified"
YES_MARK = "✅"
NO_MARK = "❌"

# Category and region codes per source: name -> code used in its addresses.
CATEGORY_CODES = {
    "jobs_ge": {
        "All Categories": "",
        "Administration/Management": "1",
        "Finance, Statistics": "3",
        "Sales/Procurement": "2",
        "PR/Marketing": "4",
        "General Technical Staff": "18",
        "Logistics/Transport/Distribution": "5",
        "Construction/Repair": "11",
        "Cleaning": "16",
        "Security/Safety": "17",
        "IT/Programming": "6",
        "Media/Publishing": "13",
        "Education": "12",
        "Law": "7",
        "Medicine/Pharmacy": "8",
        "Beauty/Fashion": "14",
        "Food": "10",
        "Other": "9",
    },
    "cv_ge": {
        "All Categories": "",
        "Administration": "admin",
        "Finance": "finance",
        "Sales": "sales",
        "IT/Programming": "it",
        "Medicine": "medicine",
        "Education": "education",
        "Other": "other",
    },
    "ss_ge": {
        "All Categories": "",
        "Administration": "admin",
        "Finance": "finance",
        "Sales": "sales",
        "IT/Programming": "it",
        "Medicine": "medicine",
        "Education": "education",
        "Marketing": "marketing",
        "Other": "other",
    },
}
LOCATION_CODES = {
    "jobs_ge": {
        "Any Location": "",
        "Tbilisi": "1",
        "Abkhazeti AR": "15",
        "Adjara AR": "14",
        "Guria": "9",
        "Imereti": "8",
        "Kakheti": "3",
        "Kvemo Kartli": "5",
        "Mtskheta-Mtianeti": "4",
        "Racha-Lechkhumi, Lw. Svaneti": "12",
        "Samegrelo-Zemo Svaneti": "13",
        "Samtskhe-Javakheti": "7",
        "Shida Kartli": "6",
        "Abroad": "16",
        "Remote": "17",
    },
    "cv_ge": {
        "Any Location": "",
        "თბილისი": "tbilisi",
        "ბათუმი": "batumi",
        "ქუთაისი": "kutaisi",
        "რუსთავი": "rustavi",
        "Other": "other",
    },
    "ss_ge": {
        "Any Location": "",
        "თბილისი": "tbilisi",
        "ბათუმი": "batumi",
        "ქუთაისი": "kutaisi",
        "რუსთავი": "rustavi",
        "ფოთი": "poti",
        "გორი": "gori",
        "Other": "other",
    },
}

# Page limits per source; None means until the first empty page.
MAX_PAGES = {"jobs_ge": None, "cv_ge": 24, "ss_ge": 50}
