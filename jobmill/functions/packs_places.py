"""Place names and codes.

Fixed values: results must equal the published rule lists, so the entries are stated
literally and in their natural order. Every classifier takes its pack as a parameter;
these are the defaults.
"""

US_STATE_CODES = [
    'AL', 'AK', 'AZ', 'AR', 'CA', 'CO', 'CT', 'DC', 'DE', 'FL', 'GA', 'HI', 'IA', 'ID',
    'IL', 'IN', 'KS', 'KY', 'LA', 'MA', 'MD', 'ME', 'MI', 'MN', 'MO', 'MS', 'MT', 'NC',
    'ND', 'NE', 'NH', 'NJ', 'NM', 'NV', 'NY', 'OH', 'OK', 'OR', 'PA', 'RI', 'SC', 'SD',
    'TN', 'TX', 'UT', 'VA', 'VT', 'WA', 'WI', 'WV', 'WY',
]

US_STATE_NAMES = [
    'Alabama', 'Alaska', 'Arizona', 'Arkansas', 'California', 'Colorado', 'Connecticut',
    'Delaware', 'Florida', 'Georgia', 'Hawaii', 'Idaho', 'Illinois', 'Indiana', 'Iowa',
    'Kansas', 'Kentucky', 'Louisiana', 'Maine', 'Maryland', 'Massachusetts', 'Michigan',
    'Minnesota', 'Mississippi', 'Missouri', 'Montana', 'Nebraska', 'Nevada',
    'New Hampshire', 'New Jersey', 'New Mexico', 'New York', 'North Carolina',
    'North Dakota', 'Ohio', 'Oklahoma', 'Oregon', 'Pennsylvania', 'Rhode Island',
    'South Carolina', 'South Dakota', 'Tennessee', 'Texas', 'Utah', 'Vermont', 'Virginia',
    'Washington', 'West Virginia', 'Wisconsin', 'Wyoming', 'District of Columbia',
]

US_CITY_CODES = [
    'SF', 'NYC', 'LA', 'DC', 'ATL', 'BOS', 'SEA', 'CHI', 'PHX', 'DEN', 'AUS', 'MIA', 'PDX',
    'DFW', 'SLC',
]

US_CITIES = [
    'New York', 'Los Angeles', 'San Francisco', 'Chicago', 'Seattle', 'Boston', 'Austin',
    'Denver', 'Atlanta', 'Miami', 'Phoenix', 'Dallas', 'Houston', 'San Jose', 'San Diego',
    'Portland', 'Nashville', 'Minneapolis', 'Detroit', 'Philadelphia', 'Charlotte',
    'Washington', 'Las Vegas', 'Salt Lake City', 'Sacramento', 'Pittsburgh', 'Baltimore',
    'Cincinnati', 'Columbus', 'Cleveland', 'Indianapolis', 'Kansas City', 'St. Louis',
    'Tampa', 'Orlando', 'Raleigh', 'Richmond', 'Louisville', 'Memphis', 'Milwaukee',
    'Albuquerque', 'Tucson', 'Fresno', 'Mesa', 'Omaha', 'Colorado Springs', 'Reno',
    'Henderson', 'Buffalo', 'Fort Worth', 'El Paso', 'Arlington', 'Irvine', 'Madison',
    'Durham', 'Lubbock', 'Baton Rouge', 'Fremont', 'Gilbert', 'Birmingham', 'Rochester',
    'Spokane', 'Des Moines', 'Tacoma', 'Glendale', 'Akron', 'Knoxville', 'Providence',
    'Grand Rapids', 'Chattanooga', 'Fort Lauderdale', 'Santa Clara', 'Sunnyvale',
    'Bellevue', 'Redmond', 'Menlo Park', 'Palo Alto', 'Mountain View', 'Cupertino',
    'Santa Monica', 'Burbank', 'Pasadena', 'Scottsdale', 'Tempe', 'Chandler', 'Roseville',
    'Huntsville', 'Fayetteville', 'Gainesville', 'Tallahassee', 'Jacksonville', 'Anchorage',
    'Honolulu', 'Lafayette', 'Stennis',
]

NON_US_SIGNALS = [
    'canada', 'mexico', 'uk', 'united kingdom', 'india', 'china', 'japan', 'korea',
    'singapore', 'australia', 'germany', 'france', 'spain', 'italy', 'netherlands',
    'poland', 'brazil', 'argentina', 'colombia', 'chile', 'peru', 'israel', 'turkey',
    'ukraine', 'russia', 'pakistan', 'bangladesh', 'philippines', 'indonesia', 'malaysia',
    'thailand', 'vietnam', 'taiwan', 'hong kong', 'palestine', 'new zealand', 'sweden',
    'norway', 'denmark', 'finland', 'switzerland', 'austria', 'belgium', 'portugal',
    'czech', 'romania', 'hungary', 'bulgaria', 'croatia', 'serbia', 'egypt', 'nigeria',
    'south africa', 'kenya', 'ghana', 'uae', 'dubai', 'saudi arabia', 'qatar', 'kuwait',
    'd.f.', 'del.', 'miguel hidalgo', 'ciudad de mexico', 'cdmx', 'guadalajara',
    'monterrey', 'puebla', 'tijuana', 'eagle - d.f', 'eagle - df', 'toronto', 'vancouver',
    'montreal', 'calgary', 'ottawa', 'winnipeg', 'edmonton', 'quebec', 'ontario',
    'british columbia', 'bangalore', 'bengaluru', 'mumbai', 'delhi', 'hyderabad', 'pune',
    'chennai', 'kolkata', 'noida', 'gurugram', 'gurgaon', 'london', 'paris', 'berlin',
    'amsterdam', 'dublin', 'lyon', 'stockholm', 'copenhagen', 'oslo', 'zurich', 'geneva',
    'sydney', 'melbourne', 'auckland', 'tokyo', 'osaka', 'beijing', 'shanghai', 'shenzhen',
    'seoul', 'taipei', 'jakarta', 'kuala lumpur', 'bangkok', 'manila', 'ho chi minh',
    'tel aviv', 'istanbul', 'moscow', 'warsaw', 'prague', 'budapest', 'bucharest', 'sofia',
    'zagreb', 'belgrade', 'cairo', 'lagos', 'nairobi', 'johannesburg', 'accra', 'abu dhabi',
    'riyadh', 'doha', 'rawabi', 'penang',
]
