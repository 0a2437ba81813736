"""Fixed values of the card-transaction model.

FIXED VALUES: these must equal the model's own labels, edges and lookup rows
for results to match.  They are stated here plainly and in natural order.
"""

# ---- FIXED VALUES: band edges and labels (right-open bands; edge value goes up) ----
CREDIT_SCORE_EDGES = [580, 670, 740, 800]
CREDIT_SCORE_LABELS = ["Poor (<580)", "Fair (580-669)", "Good (670-739)",
                       "Very good (740-799)", "Exceptional (800+)"]
INCOME_EDGES = [30000, 50000, 75000, 110000]
INCOME_LABELS = ["Under $30k", "$30k-$50k", "$50k-$75k", "$75k-$110k", "$110k+"]
AGE_EDGES = [30, 45, 60, 75]
AGE_LABELS = ["Under 30", "30-44", "45-59", "60-74", "75+"]
LIMIT_EDGES = [1000, 10000, 25000, 50000]
LIMIT_LABELS = ["Under $1k", "$1k-$10k", "$10k-$25k", "$25k-$50k", "$50k+"]

# ---- FIXED VALUES: error text -> (outcome label, outcome class); key = position + 1 ----
ERROR_CLASS = [
    ("Insufficient Balance", "Insufficient balance", "Declined - funds"),
    ("Bad PIN", "Bad PIN", "Declined - cardholder"),
    ("Technical Glitch", "Technical glitch", "Declined - technical"),
    ("Bad Card Number", "Bad card number", "Declined - card data"),
    ("Bad Expiration", "Bad expiry date", "Declined - card data"),
    ("Bad CVV", "Bad CVV", "Declined - card data"),
    ("Bad Zipcode", "Bad postcode", "Declined - card data"),
]
APPROVED_OUTCOME = ("Approved", "Approved")
MULTIPLE_OUTCOME = ("Multiple errors", "Declined - multiple")

# ---- FIXED VALUES: fraud status rows (key, status, is_labelled, is_fraud, sort) ----
FRAUD_STATUS = [
    (0, "Not labelled", "No", "No", 2),
    (1, "Confirmed not fraud", "Yes", "No", 1),
    (2, "Confirmed fraud", "Yes", "Yes", 0),
]

# ---- FIXED VALUES: US state code -> name (51 rows, alphabetical by name) ----
US_STATES = [
    ("AL", "Alabama"), ("AK", "Alaska"), ("AZ", "Arizona"), ("AR", "Arkansas"),
    ("CA", "California"), ("CO", "Colorado"), ("CT", "Connecticut"), ("DE", "Delaware"),
    ("DC", "District of Columbia"), ("FL", "Florida"), ("GA", "Georgia"), ("HI", "Hawaii"),
    ("ID", "Idaho"), ("IL", "Illinois"), ("IN", "Indiana"), ("IA", "Iowa"), ("KS", "Kansas"),
    ("KY", "Kentucky"), ("LA", "Louisiana"), ("ME", "Maine"), ("MD", "Maryland"),
    ("MA", "Massachusetts"), ("MI", "Michigan"), ("MN", "Minnesota"), ("MS", "Mississippi"),
    ("MO", "Missouri"), ("MT", "Montana"), ("NE", "Nebraska"), ("NV", "Nevada"),
    ("NH", "New Hampshire"), ("NJ", "New Jersey"), ("NM", "New Mexico"), ("NY", "New York"),
    ("NC", "North Carolina"), ("ND", "North Dakota"), ("OH", "Ohio"), ("OK", "Oklahoma"),
    ("OR", "Oregon"), ("PA", "Pennsylvania"), ("RI", "Rhode Island"), ("SC", "South Carolina"),
    ("SD", "South Dakota"), ("TN", "Tennessee"), ("TX", "Texas"), ("UT", "Utah"),
    ("VT", "Vermont"), ("VA", "Virginia"), ("WA", "Washington"), ("WV", "West Virginia"),
    ("WI", "Wisconsin"), ("WY", "Wyoming"),
]

# ---- FIXED VALUES: channel normalisation ----
CHANNEL_SUFFIX = " Transaction"
CHANNEL_ORDER = [("Swipe", 1, "Card present"), ("Chip", 2, "Card present"),
                 ("Online", 3, "Card not present")]

# ---- FIXED VALUES: calendar ----
MONTH_IN_QUARTER = ["1st month", "2nd month", "3rd month"]
CALENDAR_BANDS = 5
DAYS_PER_YEAR = 365.25

# ---- FIXED VALUES: reconciliation tolerances ----
TOL_MONEY = 0.011
TOL_RATE = 1e-4
TOL_PER10K = 0.011
TOL_MULTISET = 0.02
NOISE_FLOOR_MS = 8.0
