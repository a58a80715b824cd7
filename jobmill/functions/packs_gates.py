"""Title packs of the staged title filter.

Fixed values: results must equal the published rule lists, so the entries are stated
literally and in their natural order. Every classifier takes its pack as a parameter;
these are the defaults.
"""

SENIOR_SALES_TITLES = [
    'lead ', ' lead', 'principal', 'named account', 'account executive', 'account manager',
    'vice president', 'vp ', ' vp,', 'director', 'head of', 'chief', 'president', 'partner',
    'managing director', 'solution architect', 'solutions architect', 'distinguished',
    'fellow',
]

TECH_COMPANIES = [
    'nvidia', 'intel', 'salesforce', 'crowdstrike', 'marvell', 'draftkings', 'workiva',
    'amazon', 'microsoft', 'apple', 'meta', 'google', 'ibm', 'oracle', 'sap', 'adobe',
    'qualcomm', 'amd', 'broadcom', 'ti', 'analog', 'xilinx', 'vmware', 'workday',
    'servicenow', 'splunk', 'paloaltonetworks', 'fortinet', 'netapp', 'purestorage',
    'nutanix', 'elastic', 'mongodb', 'cloudera', 'dynatrace', 'informatica', 'teradata',
    'f5', 'juniper', 'arista', 'commvault', 'verint', 'opentext', 'tibco', 'solarwinds',
    'uber', 'lyft', 'airbnb', 'doordash', 'instacart', 'atlassian', 'dropbox', 'box',
    'zendesk', 'hubspot', 'twilio', 'cloudflare', 'databricks', 'snowflake', 'palantir',
    'veeva', 'guidewire', 'paylocity', 'adp', 'paychex', 'medallia', 'qualtrics',
    'sprinklr', 'meltwater', 'okta', 'zscaler', 'pagerduty', 'sumo-logic', 'tableau',
    'microstrategy', 'nuance', 'talend', 'qlik', 'motorolasolutions', 'cisco', 'accenture',
    'deloitte', 'ge', 'boeing', 'lockheedmartin', 'raytheon', 'northropgrumman', 'abbott',
    'medtronic', 'jnj', 'merck', 'lilly', 'honeywell', 'siemens', 'fiserv', 'broadridge',
]

SOFTWARE_CONTEXT = [
    'software', 'data', 'machine learning', 'artificial intelligence', ' ai ', ' ai,',
    ' ai/', ' ai-', ' ml ', 'ml engineer', 'security', 'cyber', 'cloud', 'devops', 'sre',
    'site reliability', 'platform', 'systems', 'network', 'it ', 'it-',
]

NON_TECH_TITLES = [
    'relationship banker', 'retail banker', 'personal banker', 'associate banker', 'banker',
    'bank teller', 'teller', 'loan officer', 'mortgage', 'financial advisor',
    'wealth advisor', 'financial planner', 'insurance agent', 'insurance advisor',
    'sales manager', 'sales director', 'sales executive', 'account executive',
    'account manager', 'named account', 'retail associate', 'store associate',
    'store manager', 'cashier', 'customer service representative',
    'supply chain coordinator', 'logistics coordinator', 'warehouse associate',
    'delivery driver', 'truck driver', 'registered nurse', 'nurse practitioner', 'nursing',
    'physician', 'medical assistant', 'pharmacy technician', 'teacher', 'professor',
    'adjunct instructor', 'bookkeeper', 'payroll specialist', 'hr generalist',
    'hr coordinator', 'human resources coordinator', 'marketing coordinator',
    'marketing specialist', 'graphic designer', 'visual designer', 'apprenticeship',
    'apprentice', 'paralegal', 'legal assistant', 'real estate agent', 'property manager',
    'facilities coordinator', 'maintenance technician', 'food service', 'chef', 'cook',
    'barista', 'marine', 'mate', 'nautical', 'vessel', 'maritime', 'portfolio marketing',
    'brand manager', 'marketing manager', 'neurosurgical', 'surgical', 'clinical',
    'medical device sales', 'business development', 'm&a', 'mergers and acquisitions',
    'field sales', 'territory manager', 'account executive', 'supply chain',
    'supply chain manager', 'procurement manager', 'buyer', 'hr manager',
    'human resources manager', 'talent acquisition', 'legal counsel', 'attorney',
    'paralegal', 'compliance officer', 'financial advisor', 'wealth advisor',
    'insurance agent', 'loan officer', 'mortgage', 'underwriter', 'actuary',
    'physical therapist', 'occupational therapist', 'speech therapist', 'pharmacist',
    'pharmacy', 'dental', 'optometrist', 'electrician', 'plumber', 'hvac', 'mechanic',
    'technician', 'welder', 'machinist', 'forklift', 'warehouse', 'driver', 'delivery',
    'logistics coordinator', 'chef', 'cook', 'restaurant', 'hospitality', 'teacher',
    'instructor', 'professor', 'tutor', 'social worker', 'counselor', 'therapist',
    'security guard', 'loss prevention', 'real estate', 'property manager',
    'administrative assistant', 'receptionist', 'office manager', 'scheduling coordinator',
    'commodity analyst', 'customs', 'bindery', 'litho', 'recommerce', 'resale',
    'liquidation', 'risk manager', 'risk event', 'risk analyst', 'portfolio marketing',
    'marketing manager', 'brand manager', 'vaccines', 'vaccine', 'immunology', 'oncology',
    'business manager', 'business development manager', 'sales manager',
    'sales representative', 'sales executive', 'account manager', 'account executive',
    'account director', 'territory', 'regional manager', 'district manager',
    'operations improvement', 'operational excellence', 'quality control', 'diagnostic',
    'assay', 'laboratory', 'lab scientist', 'marine', 'maritime', 'nautical', 'tax',
    'audit', 'accounting', 'communications manager', 'pr manager', 'public relations',
]

# Regex pack of titles that always count as technical.
PROTECTED_TECH = [
    r"\bsoftware\b.*\b(?:engineer|developer)\b",
    r"\bsoftware development engineer\b",
    r"\bdata\b.*\b(?:scientist|analyst|engineer)\b",
    r"\bmachine learning\b.*\b(?:engineer|scientist|researcher|developer|analyst)\b",
    r"\bartificial intelligence\b.*\b(?:engineer|scientist|researcher|developer|analyst)\b",
    r"\bai\b.*\b(?:engineer|scientist|researcher|developer|analyst)\b",
    r"\bml\b.*\b(?:engineer|scientist|researcher|developer|analyst)\b",
    r"\bproduct\b.*\b(?:manager|analyst)\b",
    r"\bsecurity\b.*\b(?:engineer|analyst)\b",
    r"\bcyber(?:security)?\b.*\b(?:engineer|analyst)\b",
    r"\bsystems?\b.*\b(?:engineer|analyst)\b",
    r"\bcloud engineer\b",
    r"\bdevops\b",
    r"\bsre\b",
    r"\bsite reliability\b",
    r"\bplatform engineer\b",
    r"\bbusiness analyst\b",
    r"\bquantitative analyst\b",
    r"\bquant\b.*\b(?:analyst|developer|researcher|engineer)\b",
    r"\bit\b.*\b(?:engineer|analyst)\b",
]
