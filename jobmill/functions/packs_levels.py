"""Keyword and regex packs for experience levels.

Fixed values: results must equal the published rule lists, so the entries are stated
literally and in their natural order. Every classifier takes its pack as a parameter;
these are the defaults.
"""

EXCLUSION = [
    'senior ', ' senior', 'sr. ', 'sr ', 'staff engineer', 'staff software', 'staff data',
    'staff ml', 'staff machine', 'staff product', 'staff analyst', 'staff developer',
    'senior staff', 'senior principal', 'principal engineer', 'principal software',
    'principal data', 'principal ml', 'principal scientist', 'principal architect',
    'principal analyst', 'distinguished engineer', 'distinguished scientist',
    'distinguished member', 'senior member of technical staff', '\\bsmts\\b',
    'technical fellow', 'google fellow', 'ieee fellow', 'engineering manager',
    'manager, software', 'manager of engineering', 'manager of software',
    'engineering director', 'director of engineering', 'director of software',
    'director of data', 'director of ml', 'director of product', 'director of analytics',
    'group manager', 'area manager', 'engagement manager', 'vp of engineering',
    'vp of software', 'vice president', 'head of engineering', 'head of software',
    'head of data', 'head of product', 'head of ml', 'head of ai', 'lead engineer',
    'lead developer', 'lead scientist', 'lead software', 'lead architect', 'tech lead',
    'technical lead', 'senior technical', 'software engineer ii', 'software engineer 2',
    'software engineer iii', 'software engineer 3', 'swe ii', 'swe 2', 'sde ii', 'sde 2',
    'sde iii', 'sde 3', 'engineer ii', 'engineer 2', 'engineer iii', 'engineer 3',
    'engineer iv', 'engineer 4', 'engineer v', 'engineer 5', 'developer ii', 'developer 2',
    'developer iii', 'developer 3', 'developer iv', 'developer 4', 'scientist ii',
    'scientist 2', 'scientist iii', 'scientist 3', 'analyst ii', 'analyst 2', 'analyst iii',
    'analyst 3', 'software development engineer ii', 'software development engineer 2',
    'mts ii', 'mts 2', 'specialist ii', 'specialist 2', 'specialist iii', 'specialist 3',
    ' l4 ', ' l5 ', ' l6 ', ' l7 ', ' l8 ', ' e4 ', ' e5 ', ' e6 ', ' e7 ', ' p2 ', ' p3 ',
    ' p4 ', ' p5 ', ' m1 ', ' m2 ', ' g7+ ', ' g8+ ', 'mid-level', 'mid level', 'midlevel',
    '3+ years', '4+ years', '5+ years', '6+ years', '7+ years', '8+ years', '10+ years',
    '12+ years', '15+ years', 'senior associate', 'enterprise architect',
    'solutions architect', 'senior solutions architect', 'senior product manager',
    'senior pm', 'senior data scientist', 'senior data science', 'senior data analyst',
    'senior data engineer', 'senior machine learning', 'senior ml',
    'senior software engineer', 'senior software developer', 'senior backend',
    'senior frontend', 'senior full stack', 'senior devops', 'senior sre',
    'senior platform', 'senior security', 'senior cloud', 'senior mobile', 'senior ios',
    'senior android', 'senior embedded', 'senior research', 'senior applied',
    'senior analytics', 'senior business analyst', 'senior consultant',
    'managing consultant', 'manager consultant', 'principal consultant', 'senior quant',
    'managing director', 'vp ', ' md ', 'director of', 'postdoc', 'post-doc',
    'postdoctoral', 'senior technical program',
]

INTERNSHIP = [
    'intern ', ' intern', 'internship', 'interns,', 'co-op', 'coop', 'co op',
    'co-operative', 'fall co-op', 'spring co-op', 'engineering co-op',
    'software engineering co-op', 'co-op student', 'cooperative education student',
    'coop student', 'summer 2025', 'summer 2026', 'summer 2027', 'summer intern',
    'summer analyst', 'fall 2025', 'fall 2026', 'winter 2026', 'winter intern',
    'spring 2026', 'spring 2027', 'january 2026', 'may 2026', 'june 2026', 'july 2026',
    'august 2026', 'september 2026', 'january 2027', '2025 intern', '2026 intern',
    '2027 intern', 'software engineering intern', 'software engineer, internship',
    'intern - software engineer', 'vehicle software engineering intern', 'swe intern',
    'sde intern', 'ai/ml intern', 'data science intern', 'security intern', 'design intern',
    'student developer', 'student engineer', 'student researcher', 'student analyst',
    'student scientist', 'student programmer', 'student fellow', 'undergraduate fellow',
    'undergrad researcher', 'undergraduate researcher', 'phd intern', 'doctoral intern',
    'graduate intern', 'research intern', 'software intern', 'engineering intern',
    'data intern', 'product intern', 'ml intern', 'ai intern', 'pm intern',
    'intern program', 'internship program', 'internship rotation', 'university intern',
    'rotational intern', 'practicum', 'extern', 'externship', 'apprentice',
    'apprenticeship', 'part-time student', 'part time student', 'werkstudent',
]

NEW_GRAD = [
    'new grad', 'new graduate', 'new-grad', 'new-graduate', 'new college grad',
    'new college graduate', 'new college hire', 'college grad', 'college graduate',
    'college hire', 'university grad', 'university graduate', 'university new grad',
    'university grad hire', 'campus hire', 'campus recruit', 'campus entry',
    'campus recruiting', 'early career', 'early-career', 'early professional',
    'early-professional', 'university hire', 'university recruiting', 'graduate program',
    'graduate leadership', 'graduate rotational', 'rotational program', 'rotation program',
    'phd graduate', 'ms graduate', 'bachelor graduate', 'grad hire', 'hire program',
    'graduate scheme', '2023 grad', '2024 grad', '2025 grad', '2026 grad', '2027 grad',
    '2023 graduate', '2024 graduate', '2025 graduate', '2026 graduate', '2027 graduate',
    'class of 2023', 'class of 2024', 'class of 2025', 'class of 2026', 'class of 2027',
    'recently graduated', 'fresh graduate', 'fresher', 'bachelor new grad',
    'masters new grad', 'software engineer i', 'software engineer i ',
    'software engineer 1', 'software engineer 1 ', 'sde i', 'sde i ', 'sde1', 'sde 1',
    'swe i', 'swe i ', 'swe1', 'swe 1', 'se i ', 'software development engineer i',
    'software development engineer 1', 'engineer i ', 'engineer 1 ', 'engineer level i',
    'engineer level 1', 'developer i ', 'developer 1 ', 'analyst i ', 'analyst 1 ',
    'scientist i ', 'scientist 1 ', 'pm 1 ', 'apm 1', 'level 1', 'level i', 'ic1', 'ic2',
    'junior ', 'jr. ', 'jr ', 'associate software engineer', 'associate swe',
    'associate sde', 'associate data engineer', 'associate data scientist',
    'associate data analyst', 'associate machine learning', 'associate ml engineer',
    'associate developer', 'associate product manager', 'associate analyst',
    'associate scientist', 'associate researcher', 'associate engineer', 'entry engineer',
    'graduate software engineer', 'graduate engineer', 'new grad software',
    'new grad engineer', 'new grad data', 'new grad ml', 'new grad swe', 'new grad sde',
    'software engineer new grad', 'software ai engineer new grad', '2025 new grad',
    '2026 new grad', '2025 start', '2026 start', 'summer 2026 new grad',
    'winter 2026 new grad', 'l3 software', 'l3 engineer', 'e3 engineer', 'e3 software',
    'l3 ', 'e3 ', 'edp ', 'yfir', 'leap program', 'ignite program', 'spark program',
    'launch program', 'ascend program', 'propel program', 'associate program',
    'analyst program', 'engineer program', 'developer program',
    'technology analyst program', 'technology analyst 20', 'technology analyst 2025',
    'technology analyst 2026', 'it analyst 20', 'software analyst 20',
    'americas technology full-time analyst', 'technology full-time analyst',
    'quant researcher new', 'quant developer new', 'new college grad 2025',
    'new college grad 2026', 'new college grad 2027', 'student to professional',
    'campus to career', 'early career engineer', 'early career developer',
    'early career software', 'early career data', '\\bng(?:\\b|,|-)', '\\bl1\\b',
    '\\bl2\\b', '\\bl3\\b',
]

ENTRY_LEVEL = [
    'entry level', 'entry-level', 'entrylevel', 'entry level software',
    'entry level engineer', 'entry level developer', 'entry level data',
    'entry level analyst', '0-1 year', '0-2 year', '0-3 year', '0 to 1 year', '0 to 2 year',
    '0 to 3 year', '0-1 years experience', '0-2 years experience', '0-3 years experience',
    '1-2 year', '1-3 year', '1 to 2 year', '1 to 3 year', 'up to 1 year', 'up to 2 years',
    'up to 3 years', 'less than 1 year', 'less than 2 years', 'less than 3 years',
    'no experience required', 'no prior experience', 'recent graduate', 'recent grad',
    'recently graduated', 'bs/ms', 'b.s./m.s.', "bachelor's or master's",
    'full-time analyst', 'fulltime analyst', 'analyst program', 'engineer program',
    'technology analyst', 'software analyst', 'campus entry-level', 'campus entry level',
    'emerging talent', 'emerging engineer', 'emerging professional',
    'software engineer early career', 'early career opportunity', 'early professional',
    'early-professional', 'associate engineer', 'associate developer', 'fresh graduate',
    'fresher', '2025 graduates', '2026 graduates', '2027 graduates', 'graduating in 2025',
    'graduating in 2026', 'graduating in 2027', 'graduating students', 'graduating seniors',
    "bachelor's degree required", 'bachelor degree required',
]

NEW_GRAD_TEXT = [
    'graduating in 2025', 'graduating in 2026', 'graduating in 2027', 'graduate of 2025',
    'graduate of 2026', 'graduate of 2027', 'class of 2025', 'class of 2026',
    'class of 2027', 'graduating december 2025', 'graduating may 2026',
    'graduating december 2026', 'graduating may 2027', 'planning on graduating in 2026',
    'planning on graduating in 2027', 'expected graduation', 'anticipated graduation',
    'degree candidate', "bachelor's degree candidate", 'final year student',
    'final-year student', '0-1 year', '0-2 year', '0 to 1 year', '0 to 2 year', '0-1 years',
    '0-3 years', 'recent graduate', 'recent grad', 'new graduate', 'new grad',
    'recent graduates encouraged', 'first full-time role',
    'limited prior professional experience', 'no prior experience required',
    'no experience required', 'no experience necessary', 'no prior work experience',
    'campus recruit', 'university recruit', 'college recruit', '2025 start', '2026 start',
    '2027 start', 'early career', 'rotational program', 'graduate program',
    'graduate scheme', 'training program', 'rotational engineer', 'new hire program',
    'must have completed degree', 'completed degree by',
    'eligible to work full-time after graduation', 'this should be your final internship',
]

RESCUE = [
    'new grad', 'new graduate', 'recent graduate', 'recent grad', 'no experience',
    'no prior experience', 'bachelor', 'bs/ms', 'b.s.', 'b.s ', 'degree candidate',
    'student', '0-2', '0-3', '0 to 2', '0 to 3', '0-2 years', '0-3 years', '0 to 2 years',
    '0 to 3 years', 'no experience required', 'will train', 'training provided',
    'entry level', 'entry-level', 'early career', 'early-career', 'class of 2025',
    'class of 2026', 'university graduate', 'college graduate', 'fresh graduate',
]

# Regex packs of the strict early-career check.
STRICT_TITLE = [
    r"\bsenior\b",
    r"\bsr\.?\b",
    r"\bstaff\b",
    r"\bprincipal\b",
    r"\blead\b",
    r"\bmanager\b",
    r"\bdirector\b",
    r"\bhead\b",
    r"\bchief\b",
    r"\bvice president\b",
    r"\bvp\b",
    r"\btechnical fellow\b",
    r"\bgoogle fellow\b",
    r"\bpost-?doc(?:toral)?\b",
    r"\bexperienced\b",
    r"\bmid(?:-|\s)?level\b",
    r"\bexpert\b",
    r"\barchitect\b",
    r"\blevel\s*[3-9]\b",
    r"\biii\b",
    r"\biv\b",
    r"\bii\b",
]

EARLY_CAREER = [
    r"\bnew grad",
    r"\bentry(?:-|\s)?level",
    r"\brecent grad",
    r"\brecent graduate",
    r"\bearly(?:-|\s)?career",
    r"\bearly(?:-|\s)?professional",
    r"\bjunior\b",
    r"\bassociate\b",
    r"\bapm\b",
    r"\bintern(?:ship)?\b",
    r"\bco(?:-|\s)?op\b",
    r"\bapprentice(?:ship)?\b",
    r"\brotational\b",
    r"\brpm\b",
    r"\bpm\s*1\b",
    r"\b0\s*(?:-|to)\s*1\b",
    r"\b0\s*(?:-|to)\s*2\b",
    r"\b0\s*(?:-|to)\s*3\b",
    r"\b1\s*(?:-|to)\s*2\b",
]

# The year counts share one pattern: tried one by one over long texts they cost ten times
# as much.
TOO_EXPERIENCED = [
    r"\b2\+\s*years?\s+(?:of\s+)?experience\b",
    r"\b(?:minimum|at least|over|more than)?\s*(?:3|4|5|6|7|8|9|10|12|15)\+?\s+years?\s+(?:of\s+)?experience\b",
    r"\bminimum\s+3\s+years?\b",
    r"\bminimum\s+4\s+years?\b",
    r"\bminimum\s+5\s+years?\b",
    r"\b3\s*(?:-|to)\s*5\s+years?\s+(?:of\s+)?experience\b",
    r"\b4\s*(?:-|to)\s*6\s+years?\s+(?:of\s+)?experience\b",
    r"\b5\s*(?:-|to)\s*7\s+years?\s+(?:of\s+)?experience\b",
]
