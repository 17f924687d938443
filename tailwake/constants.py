"""Fixed values the results depend on: thresholds, weights and lookup tables."""

# --- fixed values: report plausibility limits (inclusive) ---
ALTITUDE_FT = (1000, 60000)
SPEED_KN = (50, 700)
HEADING_DEG = (0, 360)

# --- fixed values: defaults for missing fields ---
NUMERIC_DEFAULTS = {
    "precipitation_mm": 0.0,
    "wind_knots": 0.0,
    "visibility_m": 10000.0,
    "weather_code": 0,
}
TEXT_DEFAULT = "UNKNOWN"
TEXT_DEFAULT_COLUMNS = ("airline_icao", "aircraft_model", "origin", "destination")

# --- fixed values: category names ---
ON_TIME, MEDIUM_DELAY, CRITICAL_DELAY = "ON TIME", "MEDIUM DELAY", "CRITICAL DELAY"
DELAYED = (MEDIUM_DELAY, CRITICAL_DELAY)
LOW, MODERATE, HIGH, CRITICAL = "LOW", "MODERATE", "HIGH", "CRITICAL"
ELEVATED = (HIGH, CRITICAL)
CLEAR, SEVERE = "CLEAR", "SEVERE"
EXCELLENT, GOOD, FAIR, POOR = "EXCELLENT", "GOOD", "FAIR", "POOR"

# --- fixed values: time of day and traffic ---
MORNING_PEAK, EVENING_PEAK, MIDDAY = (6, 9), (17, 20), (10, 16)
WEEKDAYS = (2, 6)  # 1 = Sunday

# --- fixed values: retention and horizons, seconds ---
LIVE_TTL_S = 300
ALERT_TTL_S = 3600
ROTATION_HORIZON_S = 86400
WEATHER_TTL_S = 1800
FAILED_WEATHER_TTL_S = 300
GOLD_REFRESH_S = 300

# --- fixed values: seats by aircraft type, and the usual load ---
AIRCRAFT_CAPACITY = {
    "A20N": 180, "A21N": 220, "A319": 150, "A320": 180, "A321": 220,
    "A332": 250, "A333": 300, "A343": 300, "A359": 325,
    "B738": 189, "B739": 215, "B73H": 189, "B744": 416, "B748": 467,
    "B752": 200, "B763": 290, "B772": 400, "B773": 450, "B77W": 396,
    "B788": 250, "B789": 290, "B78X": 330,
    "CRJ9": 90, "E190": 100, "E195": 120,
}
DEFAULT_CAPACITY = 180
LOAD_FACTOR = 0.85

# --- fixed values: hub airports ---
HUB_AIRPORTS = (
    "KUL", "SIN", "CGK", "BKK", "MNL", "HAN", "SGN", "RGN", "PNH",
    "HKG", "PVG", "PEK", "ICN", "NRT", "HND", "TPE",
    "DXB", "DOH", "AUH", "IST",
    "LHR", "CDG", "FRA", "AMS", "MAD", "FCO", "MUC",
    "JFK", "LAX", "ORD", "ATL", "DFW", "SFO", "SEA",
)

# --- fixed values: airports (IATA, ICAO, name, country, latitude, longitude) ---
AIRPORTS = (
    ("PKY", "WAGG", "Palangkaraya Tjilik Riwut Airport", "🇮🇩", -2.2246, 113.9436),
    ("CGK", "WIII", "Soekarno-Hatta Int. Airport", "🇮🇩", -6.1255, 106.6558),
    ("DPS", "WADD", "Ngurah Rai Int. Airport", "🇮🇩", -8.7481, 115.1672),
    ("SUB", "WARR", "Juanda Int. Airport", "🇮🇩", -7.3798, 112.7836),
    ("KNO", "WIMM", "Kualanamu Int. Airport", "🇮🇩", 3.6300, 98.8797),
    ("UPG", "WAAA", "Sultan Hasanuddin Int. Airport", "🇮🇩", -5.0616, 119.5540),
    ("BPN", "WALL", "Sepinggan Int. Airport", "🇮🇩", -1.2682, 116.8943),
    ("YIA", "WAHI", "Yogyakarta Int. Airport", "🇮🇩", -7.9009, 110.0594),
    ("PLM", "WIPP", "Sultan Mahmud Badaruddin II", "🇮🇩", -2.8981, 104.7001),
    ("SRG", "WAHS", "Jenderal Ahmad Yani", "🇮🇩", -6.9723, 110.3756),
    ("PDG", "WIEE", "Minangkabau Int. Airport", "🇮🇩", -0.7863, 100.2809),
    ("BDO", "WICC", "Husein Sastranegara", "🇮🇩", -6.9009, 107.5756),
    ("BDJ", "WAOO", "Syamsudin Noor Airport", "🇮🇩", -3.4406, 114.7621),
    ("PNK", "WIOO", "Supadio Int. Airport", "🇮🇩", -0.1491, 109.4042),
    ("LOP", "WADL", "Lombok Int. Airport", "🇮🇩", -8.7578, 116.2750),
    ("MDC", "WAMM", "Sam Ratulangi Int. Airport", "🇮🇩", 1.5492, 124.9261),
    ("SIN", "WSSS", "Singapore Changi Airport", "🇸🇬", 1.3644, 103.9915),
    ("KUL", "WMKK", "Kuala Lumpur Int. Airport", "🇲🇾", 2.7456, 101.7099),
    ("LHR", "EGLL", "London Heathrow Airport", "🇬🇧", 51.4700, -0.4543),
)

# --- fixed values: airline names by ICAO code ---
AIRLINE_NAMES = {
    "GIA": "Garuda Indonesia",
    "LNI": "Lion Air",
    "CTV": "Citilink",
    "BTK": "Batik Air",
    "SJW": "Super Air Jet",
    "SJV": "Super Air Jet",
    "AWQ": "Indonesia AirAsia",
    "SJY": "Sriwijaya Air",
    "NAM": "NAM Air",
    "TGA": "Trigana Air",
    "TNU": "TransNusa",
    "MWG": "AirBorneo",
    "OEY": "Rimbun Air",
    "WON": "Wings Air",
    "SQS": "Susi Air",
    "PAS": "Pelita Air",
    "LKN": "NAM Air",
    "TGN": "Trigana Air",
    "FHS": "FlyJaya",
    "JLB": "Jhonlin Air Transport",
    "MYU": "My Indo Airlines",
    "CAD": "Cardig Air",
    "TMG": "Tri-MG Intra Asia Airlines",
    "AFE": "Airfast Indonesia",
    "IDA": "Indonesia Air Transport",
    "TVV": "Travira Air",
    "ESD": "Eastindo Air",
    "XAR": "Xpress Air",
    "AXM": "AirAsia",
    "SIA": "Singapore Airlines",
    "MAS": "Malaysia Airlines",
    "THA": "Thai Airways",
    "JST": "Jetstar",
    "QFA": "Qantas",
    "UAE": "Emirates",
    "QTR": "Qatar Airways",
    "SVA": "Saudia",
    "ANA": "All Nippon Airways",
    "JAL": "Japan Airlines",
    "CPA": "Cathay Pacific",
    "CAL": "China Airlines",
    "EVA": "EVA Air",
    "ETH": "Ethiopian Airlines",
    "DKH": "Juneyao Airlines",
    "AIH": "Air Incheon",
    "FFM": "Firefly",
    "FIN": "Finnair",
    "BAW": "British Airways",
    "AFR": "Air France",
    "DLH": "Lufthansa",
    "KLM": "KLM Royal Dutch Airlines",
    "DAL": "Delta Air Lines",
    "AAL": "American Airlines",
    "UAL": "United Airlines",
    "THY": "Turkish Airlines",
    "VJC": "VietJet Air",
    "SLK": "SilkAir",
    "TGW": "Scoot",
    "AXB": "AirAsia X",
    "AWX": "Indonesia AirAsia X",
    "MXD": "Malindo Air",
    "OAL": "Olympic Air",
    "KAL": "Korean Air",
    "AAR": "Asiana Airlines",
    "CES": "China Eastern Airlines",
    "CSN": "China Southern Airlines",
    "CCA": "Air China",
    "HVN": "Vietnam Airlines",
    "BKP": "Bangkok Airways",
    "TFW": "IndiGo",
    "PAL": "Philippine Airlines",
    "RPA": "Royal Brunei Airlines",
    "GFA": "Gulf Air",
    "ETD": "Etihad Airways",
    "FDB": "flydubai",
    "ELY": "El Al Israel Airlines",
    "MHD": "Mahan Air",
    "AMQ": "Aeroméxico",
    "BOE": "WestJet",
    "SWR": "Swiss International Air Lines",
    "AUA": "Austrian Airlines",
    "BEL": "Brussels Airlines",
    "IBE": "Iberia",
    "TAP": "TAP Air Portugal",
    "AZA": "ITA Airways",
    "VLG": "Vueling",
    "NLY": "Edelweiss Air",
    "CXI": "Cebu Pacific",
    "TBA": "Tibet Airlines",
    "CSZ": "Shenzhen Airlines",
    "CDG": "Shandong Airlines",
    "CHH": "Hainan Airlines",
    "XAM": "Xiamen Airlines",
    "CFI": "Sichuan Airlines",
    "UIA": "Ukraine International Airlines",
    "AFL": "Aeroflot",
    "RMF": "Royal Malaysian Air Force",
    "VOZ": "Virgin Australia",
    "BVT": "Berjaya Air",
    "OMA": "Oman Air",
    "KXP": "Kargo Express",
    "BBL": "BBN Airlines Indonesia",
    "RBA": "Royal Brunei Airlines",
    "RCH": "Komando Mobilitas Udara Angkatan Udara Amerika Serikat",
}
UNKNOWN_AIRLINE = "Unknown Airline"
