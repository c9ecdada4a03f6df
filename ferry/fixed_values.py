"""Fixed values.

Everything in this file is data that results depend on: names, patterns,
limits, word lists and literal rows. Each value is stated as it must be.
"""

# -- user records ------------------------------------------------------------

USER_COLUMNS = ["first_name", "last_name", "email", "phone", "gender"]
REQUIRED_TO_VALIDATE = ["first_name", "last_name", "email", "phone"]

EMAIL_PATTERN = r"^[a-zA-Z0-9._%+-]+@ais\.com$"
PHONE_PATTERN = r"^(06|08|09)\d{8}$"

# Limits of the relational user table: VARCHAR lengths and the gender check.
USER_TABLE_LENGTHS = {
    "first_name": 255,
    "last_name": 255,
    "email": 255,
    "phone": 50,
    "gender": 1,
}
GENDERS = ["M", "F"]

# -- version ledger ----------------------------------------------------------

LEDGER_COLUMNS = ["db", "test_version", "created_at", "updated_at"]
FIRST_VERSION = 1.0
VERSION_STEP = 0.1

LITERAL_LEDGER_DOCUMENTS = [
    {
        "_id": "692e70b188f5be0a2645bc81",
        "created_at": "2025-12-03T03:58:47.994Z",
        "db": "mongodb",
        "test_version": 1.2,
        "updated_at": "2025-12-03T03:58:47.994Z",
    },
    {
        "_id": "692e757ee851391d394ec656",
        "created_at": "2025-12-03T03:29:28.103Z",
        "db": "postgresql",
        "test_version": 1.2,
        "updated_at": "2025-12-03T03:29:28.103Z",
    },
    {
        "_id": "692e80a1f9c2d3e4a5b6c7d8",
        "created_at": "2025-12-03T04:15:33.456Z",
        "db": "mysql",
        "test_version": 1.3,
        "updated_at": "2025-12-03T04:15:33.456Z",
    },
]

# -- stores ------------------------------------------------------------------

DATABASES = ["mongodb", "postgresql"]
STORAGES = ["s3", "minio"]
LEDGER_CONTAINER = "db_connect"
USER_CONTAINER = "user"
RAW_USER_DATASET = "raw_valid_data_user"
VERSION_DATASET = "simple_json_data"
OBJECT_SCHEME = "s3a://"

# -- synthetic users ---------------------------------------------------------

FIRST_NAMES = [
    "Andrew", "Sarah", "Michael", "Emily", "James",
    "Jessica", "David", "Lisa", "Robert", "Maria",
    "John", "Patricia", "William", "Jennifer", "Richard",
    "Linda", "Thomas", "Elizabeth", "Charles", "Susan",
]
LAST_NAMES = [
    "Johnson", "Williams", "Brown", "Davis", "Wilson",
    "Martinez", "Anderson", "Taylor", "Thomas", "Moore",
    "Jackson", "Martin", "Lee", "Thompson", "White",
    "Harris", "Clark", "Lewis", "Robinson", "Walker",
]
INVALID_EMAIL_DOMAINS = [
    "gmail.com", "yahoo.com", "hotmail.com", "outlook.com", "example.com",
]
VALID_EMAIL_DOMAIN = "ais.com"
VALID_PHONE_PREFIXES = ["06", "08", "09"]
# Share in percent of each kind of row.
USER_MIX = {
    "valid": 70,
    "invalid_email": 10,
    "invalid_phone": 10,
    "missing_name": 5,
    "duplicate_email": 5,
}
SYNTHETIC_ROWS = 10_000
