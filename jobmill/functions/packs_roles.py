"""Keyword packs for role tags.

Fixed values: results must equal the published rule lists, so the entries are stated
literally and in their natural order. Every classifier takes its pack as a parameter;
these are the defaults.
"""

ROLE_SWE = [
    'software engineer', 'software engineering', 'software developer',
    'software programmer', 'software eng', 'software engg', 'software development engineer',
    'software design engineer', 'swe', 'sde', 'se i', 'sde i', 'swe i', 'engineer i',
    'engineer 1', 'product engineer', 'product software engineer',
    'product software developer', 'computer engineer', 'computer scientist',
    'graduate software engineer', 'new grad software', 'software new grad',
    'associate software engineer', 'associate software developer',
    'software engineering intern', 'swe intern', 'sde intern', 'engineer, software',
    'developer, software', 'full stack', 'fullstack', 'full-stack', 'frontend', 'front end',
    'front-end', 'ui engineer', 'ui developer', 'ux engineer', 'web developer',
    'web engineer', 'web programmer', 'javascript developer', 'react developer',
    'angular developer', 'vue developer', 'node developer', 'typescript developer',
    'backend', 'back end', 'back-end', 'api developer', 'api engineer', 'java developer',
    'python developer', 'golang developer', 'go developer', 'ruby developer',
    'c++ developer', 'c# developer', 'php developer', '.net developer', 'scala developer',
    'rust developer', 'systems engineer', 'systems developer', 'systems programmer',
    'systems software', 'systems software engineer', 'systems software developer',
    'operating systems', 'distributed systems', 'distributed systems engineer',
    'software/platform', 'platform software', 'platform software engineer',
    'backend platform engineer', 'infrastructure software engineer',
    'application developer', 'application engineer', 'applications engineer',
    'application software', 'software application', 'internal tools engineer',
    'developer productivity engineer', 'tools engineer', 'developer tools',
    'developer experience', 'dx engineer', 'tooling engineer', 'integrations engineer',
    'integration engineer', 'integration developer', 'integration software',
    'microservices engineer', 'microservices developer', 'mobile engineer',
    'mobile developer', 'mobile software', 'ios engineer', 'ios developer', 'ios software',
    'android engineer', 'android developer', 'android software', 'react native',
    'flutter developer', 'swift developer', 'kotlin developer', 'embedded engineer',
    'embedded software', 'embedded systems', 'embedded developer', 'firmware engineer',
    'firmware developer', 'firmware software', 'hardware engineer', 'hardware developer',
    'fpga engineer', 'fpga developer', 'rtos engineer', 'bare metal', 'low level engineer',
    'kernel developer', 'kernel engineer', 'driver developer', 'protocol engineer',
    'rf engineer', 'radio frequency engineer', 'photonics engineer', 'optical engineer',
    'simulation engineer', 'robotics engineer', 'robotics software',
    'visualization engineer', 'graphics engineer', 'graphics programmer',
    'rendering engineer', 'shader engineer', 'game engineer', 'game developer',
    'gameplay engineer', 'engine developer', 'compiler engineer', 'programming language',
    'numerical methods', 'scientific computing', 'storage engineer', 'database engineer',
    'growth engineer', 'platform engineer', 'infrastructure engineer',
    'reliability engineer', 'site reliability', 'sre', 'performance engineer',
    'capacity engineer', 'forward deployed engineer', 'field engineer', 'build engineer',
    'release engineer', 'spacecraft software', 'avionics software', 'flight software',
    'vehicle software', 'vehicle software engineer', 'api software',
    'api software engineer', 'qa engineer', 'quality engineer', 'quality assurance',
    'test engineer', 'sdet', 'software test', 'software quality', 'automation engineer',
    'test automation', 'solutions engineer', 'solutions developer',
    'implementation engineer', 'implementation developer', 'technical support engineer',
    'support engineer', 'software architect', 'technical program manager', 'tpm',
]

ROLE_DS = [
    'data scientist', 'data science', 'data science analyst', 'staff data scientist',
    'junior data scientist', 'associate data scientist', 'quantitative data scientist',
    'analytics scientist', 'experimentation scientist', 'measurement scientist',
    'research scientist', 'applied scientist', 'applied research scientist',
    'research engineer', 'applied researcher', 'computational scientist',
    'computational researcher', 'causal inference scientist', 'causal inference engineer',
    'data engineer', 'staff data engineer', 'data engineering', 'data science intern',
    'data engineer intern', 'analytics engineer', 'analytics engineering',
    'analytics intern', 'data platform engineer', 'data infrastructure', 'etl developer',
    'etl engineer', 'pipeline engineer', 'data pipeline', 'data warehouse', 'data lake',
    'database analyst', 'database developer', 'sql developer', 'sql engineer',
    'hadoop engineer', 'spark engineer', 'kafka engineer', 'ml data engineer',
    'machine learning data', 'statistician', 'statistical analyst',
    'statistical researcher', 'biostatistician', 'econometrician', 'econometrics analyst',
    'quantitative researcher', 'quant researcher', 'quantitative scientist',
    'decision scientist', 'operations research analyst', 'operations research engineer',
    'data modeler', 'data architect', 'data solutions', 'reporting engineer', 'bi engineer',
    'bi developer', 'business intelligence', 'reporting analyst', 'reporting specialist',
    'insights analyst', 'strategy analyst', 'business intelligence engineer',
    'business intelligence developer', 'experimentation analyst', 'measurement analyst',
    'dashboard analyst', 'data reporting', 'data quality analyst', 'master data analyst',
    'spatial analyst', 'geospatial analyst', 'gis analyst', 'gis developer',
]

ROLE_ML = [
    'machine learning', 'machine learning intern', 'ml engineer', 'ml developer',
    'ml intern', 'applied machine learning engineer', 'applied ml engineer',
    'applied ml intern', 'mlops', 'ml ops', 'ml platform', 'ml platform engineer',
    'ml infrastructure', 'ml infrastructure engineer', 'machine learning platform',
    'ai engineer', 'ai/ml', 'ml systems', 'ml systems engineer', 'ml research',
    'ml scientist', 'model engineer', 'model developer', 'training engineer',
    'model training engineer', 'training infrastructure', 'inference engineer',
    'model deployment', 'model serving', 'model serving engineer', 'serving engineer',
    'feature store engineer', 'recommendation engineer', 'recommendation scientist',
    'recommendation systems', 'ranking engineer', 'ranking scientist', 'search engineer',
    'search scientist', 'search relevance', 'computer vision', 'cv engineer',
    'cv scientist', 'vision engineer', 'vision scientist', 'nlp engineer', 'nlp scientist',
    'nlp developer', 'natural language processing', 'natural language understanding',
    'speech engineer', 'speech scientist', 'speech recognition', 'audio engineer',
    'audio ml', 'vision-language', 'text-to-image', 'text-to-speech', 'multimodal engineer',
    'multimodal researcher', 'perception engineer', 'perception scientist', 'autonomous',
    'autonomy engineer', 'autonomy scientist', 'self-driving', 'slam engineer',
    'robotics learning engineer', 'autonomous systems ml', 'deep learning',
    'trustworthy ai', 'responsible ai', 'ai safety engineer', 'anomaly detection',
    'forecasting engineer', 'time series engineer', 'signal processing engineer',
    'feature engineer', 'feature platform', 'synthetic data engineer',
    'data annotation engineer', 'gpu engineer',
]

ROLE_AI = [
    'ai engineer', 'ai developer', 'ai scientist', 'artificial intelligence',
    'artificial intelligence intern', 'ai researcher', 'ai research', 'ai intern',
    'ai/ml intern', 'ai infrastructure', 'ai platform', 'ai systems', 'ai solutions',
    'deep learning', 'neural network', 'llm', 'large language model', 'llm engineer',
    'language model engineer', 'generative ai', 'generative ai engineer', 'gen ai', 'genai',
    'genai engineer', 'foundation model', 'foundation model engineer',
    'model adaptation engineer', 'fine-tuning engineer', 'finetuning engineer',
    'transformer', 'diffusion model', 'multimodal', 'synthetic data engineer',
    'data curation engineer', 'knowledge graph', 'ontology engineer', 'embeddings engineer',
    'ai agent', 'agentic', 'agent engineer', 'agentic ai engineer', 'prompt engineer',
    'prompt engineering', 'prompt designer', 'reinforcement learning', 'rl engineer',
    'rl researcher', 'rlhf trainer', 'rlhf engineer', 'rlhf researcher', 'ai evaluator',
    'model evaluator', 'llm evaluator', 'response evaluator', 'ai trainer', 'ai rater',
    'human-in-the-loop trainer', 'ai red teamer', 'ai red team', 'adversarial ml engineer',
    'ai safety', 'ai safety researcher', 'ai alignment', 'alignment researcher',
    'model alignment engineer', 'model quality engineer', 'ai quality engineer',
    'conversational ai engineer', 'chatbot engineer', 'chatbot developer',
    'reasoning engineer', 'reasoning researcher', 'ai automation', 'intelligent automation',
    'virtual assistant engineer', 'virtual assistant developer', 'ai/ml', 'ml/ai',
    'ai architect', 'ai technical',
]

ROLE_ANALYST = [
    'data analyst', 'data analytics', 'business analyst', 'business analysis',
    'business intelligence analyst', 'bi analyst', 'analytics analyst',
    'analytics associate', 'insights analyst', 'reporting analyst', 'reporting specialist',
    'dashboard analyst', 'data reporting', 'database analyst', 'data quality analyst',
    'measurement analyst', 'analyst intern', 'data analyst intern',
    'business analyst intern', 'junior analyst', 'associate analyst', 'product analyst',
    'growth analyst', 'marketing analyst', 'consumer insights', 'customer insights',
    'customer analytics', 'market research analyst', 'operations analyst', 'ops analyst',
    'operational analyst', 'process analyst', 'supply chain analyst', 'logistics analyst',
    'supply chain data', 'logistics data', 'pricing analyst', 'revenue analyst',
    'systems analyst', 'it analyst', 'functional analyst', 'web analyst', 'digital analyst',
    'seo analyst', 'sem analyst', 'technology analyst', 'technical analyst',
    'strategy analyst', 'strategic analyst', 'corporate strategy',
    'business strategy analyst', 'financial analyst', 'fp&a analyst', 'fpa analyst',
    'market analyst', 'risk analyst', 'compliance analyst', 'fraud analyst',
    'content analyst', 'quality analyst', 'corporate finance analyst', 'investment analyst',
    'research analyst', 'equity research analyst', 'credit analyst', 'loan analyst',
    'economic analyst', 'economist', 'policy analyst', 'program analyst',
    'intelligence analyst', 'research associate', 'trust and safety', 'healthcare analyst',
    'clinical data analyst', 'clinical analyst', 'real estate analyst', 'asset analyst',
    'workforce analyst', 'people analytics', 'hr analyst', 'people data', 'ux researcher',
    'user researcher', 'ux research', 'environmental analyst', 'sustainability analyst',
    'media analyst', 'advertising analyst', ' analyst',
]

ROLE_PM = [
    'product manager', 'product management', 'associate product manager', 'associate pm',
    'apm', 'product analyst', 'product operations', 'product specialist',
    'growth product manager', 'growth pm', 'consumer product manager',
    'enterprise product manager', 'rotational product manager', 'rpm',
    'technical product manager', 'technical pm', 'technical program manager', 'tpm',
    'platform product manager', 'platform pm', 'program manager',
    'associate program manager', 'product owner', 'product strategy', 'product lead',
    'product development manager', 'product intern', 'product management intern',
    'product manager intern', 'pm intern', 'apm intern', ' pm ',
]

ROLE_SECURITY = [
    'security engineer', 'security developer', 'security analyst', 'security researcher',
    'security scientist', 'security specialist', 'security associate',
    'security administrator', 'security operations', 'cybersecurity', 'cyber security',
    'cyber-security', 'cybersecurity engineer', 'cybersecurity analyst',
    'cybersecurity specialist', 'cybersecurity researcher', 'information security',
    'infosec', 'information security analyst', 'information security engineer',
    'information security specialist', 'network security', 'network security engineer',
    'network security analyst', 'application security', 'appsec', 'app security',
    'product security', 'software security', 'web application security',
    'security software engineer', 'cloud security', 'cloud security engineer',
    'cloud security analyst', 'devsecops', 'dev sec ops', 'soc analyst', 'soc engineer',
    'security operations center', 'threat analyst', 'incident response',
    'incident responder', 'security incident', 'security automation engineer',
    'security intern', 'cybersecurity intern', 'security engineer intern',
    'penetration tester', 'penetration testing', 'pen tester', 'pen test', 'ethical hacker',
    'red team', 'blue team', 'purple team', 'ai red teamer', 'vulnerability',
    'vulnerability analyst', 'vulnerability engineer', 'vulnerability researcher',
    'risk analyst', 'risk engineer', 'risk management engineer', 'security risk',
    'fraud engineer', 'anti-fraud engineer', 'identity engineer', 'iam engineer',
    'identity and access', 'access management', 'zero trust', 'zero trust engineer',
    'endpoint security', 'endpoint engineer', 'endpoint analyst', 'cryptography',
    'cryptographic engineer', 'privacy engineer', 'privacy analyst',
    'trust and safety engineer', 'trust and safety analyst', 'compliance engineer',
    'compliance analyst', 'grc analyst', 'governance risk', 'digital forensics',
    'forensic analyst', 'forensics engineer', 'malware analyst', 'threat intelligence',
    'reverse engineer', 'reverse engineering', 'threat hunter', 'threat hunting',
    'cyber analyst', 'cyber engineer',
]

ROLE_DEVOPS = [
    'devops', 'dev ops', 'devops engineer', 'devops developer', 'devops associate',
    'associate devops', 'junior devops', 'junior devops engineer', 'devops intern',
    'platform intern', 'cloud intern', 'infrastructure intern', 'site reliability', 'sre',
    'reliability engineer', 'site reliability engineer', 'platform engineer',
    'platform developer', 'infrastructure engineer', 'infrastructure developer',
    'infrastructure as code', 'iac engineer', 'terraform engineer', 'ansible engineer',
    'puppet engineer', 'chef engineer', 'cloud engineer', 'cloud developer',
    'cloud operations', 'cloud infrastructure', 'cloud devops', 'aws engineer',
    'azure engineer', 'gcp engineer', 'cloud practitioner', 'cloud support engineer',
    'cloud support associate', 'cloud systems administrator', 'cloud administrator',
    'systems administrator', 'sysadmin', 'sys admin', 'systems reliability',
    'linux engineer', 'linux administrator', 'linux systems', 'virtualization engineer',
    'vmware engineer', 'network engineer', 'network administrator', 'network developer',
    'network operations', 'it operations', 'it infrastructure', 'technical operations',
    'tech ops', 'database administrator', 'dba', 'database engineer', 'automation engineer',
    'build and release', 'release manager', 'ci/cd engineer', 'cicd engineer',
    'pipeline engineer', 'kubernetes engineer', 'k8s engineer', 'container engineer',
    'docker engineer', 'observability engineer', 'monitoring engineer', 'chaos engineer',
    'devsecops', 'cloud native', 'gitops', 'platform operations', 'service mesh engineer',
    'istio engineer', 'storage engineer', 'compute engineer', 'backup engineer',
    'disaster recovery engineer', 'mlops', 'dataops',
]

ROLE_CONSULTING = [
    'consultant', 'consulting', 'consulting intern', 'consultant intern', 'strategy intern',
    'junior consultant', 'entry consultant', 'technology consultant', 'tech consultant',
    'it consultant', 'it consulting', 'management consultant', 'strategy consultant',
    'business consultant', 'business consulting', 'strategy consulting',
    'digital transformation', 'digital consultant', 'change management',
    'organizational consultant', 'business analyst consultant', 'analyst consultant',
    'associate consultant', 'consulting analyst', 'technology analyst',
    'technology associate', 'business technology analyst', 'consulting associate',
    'associate program', 'implementation consultant', 'implementation specialist',
    'solutions consultant', 'solutions specialist', 'erp consultant', 'sap consultant',
    'oracle consultant', 'salesforce consultant', 'salesforce developer',
    'servicenow consultant', 'workday consultant', 'advisory analyst', 'advisory associate',
    'advisory consultant', 'risk advisory', 'risk consultant', 'financial advisory',
    'deals analyst', 'systems integration', 'si consultant', 'enterprise solutions',
    'enterprise consultant', 'client services analyst', 'deloitte analyst', 'pwc analyst',
    'kpmg analyst', 'ey analyst', 'human capital', 'workforce consultant',
    'organizational design',
]

ROLE_FINANCE = [
    'quantitative analyst', 'quant analyst', 'quantitative researcher', 'quant researcher',
    'quantitative developer', 'quant developer', 'quantitative trader', 'quant trader',
    'quantitative engineer', 'quant engineer', 'quantitative strategist',
    'quant strategist', 'quantitative associate', 'quant intern', 'junior quant',
    'algorithmic trading', 'algorithmic trading engineer', 'algo trading', 'algo trader',
    'electronic trading', 'systematic trading', 'trading analyst', 'trading associate',
    'trading developer', 'trading intern', 'execution trader', 'junior trader',
    'derivatives analyst', 'financial engineer', 'financial engineering',
    'financial software engineer', 'strats', 'digital strats', 'multi asset',
    'structured products', 'fixed income analyst', 'rates analyst', 'credit analyst',
    'fx analyst', 'investment banking analyst', 'investment banking intern',
    'investment analyst', 'equity research', 'credit research', 'portfolio analyst',
    'portfolio associate', 'asset management analyst', 'wealth management analyst',
    'hedge fund analyst', 'private equity analyst', 'risk analyst', 'risk associate',
    'risk engineer', 'market risk', 'credit risk', 'operational risk', 'model risk',
    'risk modeling', 'fintech', 'financial technology', 'payments engineer',
    'payments analyst', 'banking technology', 'capital markets technology',
    'blockchain developer', 'smart contract developer', 'web3 developer', 'defi engineer',
    'crypto analyst', 'crypto engineer', 'cryptocurrency analyst', 'treasury analyst',
    'corporate finance analyst', 'finance intern', 'fp&a', 'fpa analyst',
    'financial planning', 'actuarial analyst', 'actuary', 'actuarial associate',
    'actuarial science', 'staff accountant', 'accounting analyst', 'audit associate',
    'audit analyst', 'external audit', 'internal audit', 'tax analyst', 'tax associate',
    'controller', 'accounting associate', 'summer analyst',
]

TARGET_SWE = [
    'software engineer', 'software engineering', 'software developer',
    'software development engineer', 'software programmer', 'software eng', 'developer',
    'swe', 'sde', 'product engineer', 'computer engineer', 'frontend engineer',
    'frontend developer', 'front end engineer', 'front-end engineer', 'backend engineer',
    'backend developer', 'back end engineer', 'back-end engineer', 'full stack engineer',
    'full stack developer', 'fullstack engineer', 'fullstack developer', 'web engineer',
    'web developer', 'mobile engineer', 'mobile developer', 'ios engineer', 'ios developer',
    'android engineer', 'android developer', 'application engineer',
    'application developer', 'platform software', 'platform software engineer',
    'distributed systems engineer', 'systems software engineer', 'internal tools engineer',
    'microservices engineer', 'api engineer', 'api developer', 'api software engineer',
    'software engineering intern', 'graduate software engineer',
]

TARGET_DS = [
    'data scientist', 'data science', 'data engineer', 'analytics engineer', 'data analyst',
    'business intelligence', 'bi analyst', 'bi engineer', 'research scientist',
    'applied scientist', 'applied research scientist', 'data science analyst',
    'analytics scientist', 'decision scientist', 'quantitative analyst', 'quant analyst',
    'operations research analyst', 'data science intern', 'database analyst',
    'sql developer', 'geospatial analyst',
]

TARGET_ML = [
    'machine learning', 'ml engineer', 'ml scientist', 'ml researcher', 'ml developer',
    'deep learning', 'nlp engineer', 'nlp scientist', 'machine learning intern',
    'applied machine learning engineer', 'ml platform engineer', 'ml systems engineer',
    'computer vision', 'cv engineer', 'cv scientist', 'model serving engineer',
    'feature store engineer', 'multimodal engineer', 'text-to-image', 'mlops',
]

TARGET_AI = [
    'artificial intelligence', 'ai engineer', 'ai scientist', 'ai researcher', 'llm',
    'large language model', 'generative ai', 'genai', 'gen ai', 'ai intern',
    'artificial intelligence intern', 'generative ai engineer', 'llm engineer',
    'foundation model', 'foundation model engineer', 'prompt engineer', 'prompt designer',
    'agent engineer', 'ai safety', 'conversational ai engineer', 'reasoning engineer',
    'embeddings engineer', 'ai/ml', 'ml/ai',
]

TARGET_ANALYST = [
    'data analyst', 'business analyst', 'business intelligence analyst', 'bi analyst',
    'analytics analyst', 'product analyst', 'technical analyst', 'technology analyst',
    'research analyst', 'strategy analyst', 'operations analyst', 'dashboard analyst',
    'reporting specialist', 'healthcare analyst', 'workforce analyst', 'ux researcher',
    'customer insights',
]

TARGET_PM = [
    'product manager', 'product management', 'associate product manager', 'apm',
    'technical product manager', 'product analyst', 'product management intern',
    'product manager intern', 'rotational product manager', 'rpm', 'growth product manager',
    'platform pm', 'product strategy', 'associate program manager',
]

# Regex packs on titles.
TECH_SIGNAL = [
    r"\bengineer\b",
    r"\bdeveloper\b",
    r"\bscientist\b",
    r"\barchitect\b",
    r"\bdevops\b",
    r"\bsre\b",
    r"\bplatform\b",
    r"\bbackend\b",
    r"\bfrontend\b",
    r"\bfullstack\b",
    r"\bfull.?stack\b",
    r"\bmachine.?learning\b",
    r"\bsoftware\b",
    r"\bcloud\b",
    r"\bsecurity\b",
    r"\binfrastructure\b",
    r"\b(ml|ai|nlp|swe|sde|sdet|tpm)\b",
    r"\bproduct.?manager\b",
    r"\bprogram.?manager\b",
    r"\btechnical\b",
    r"\bsystems\b",
    r"\bdata\b",
    r"\bquant(itative)?\b",
    r"\banalytics\b",
    r"\bautomation\b",
    r"\bembedded\b",
    r"\bfirmware\b",
    r"\brobotic\b",
    r"\bcybersecurity\b",
    r"\bnetwork(ing)?\b",
    r"\bmobile\b",
    r"\bios\b",
    r"\bandroid\b",
    r"\bgame\b",
    r"\bgraphics\b",
    r"\bsimulation\b",
    r"\bcompiler\b",
    r"\bvirtualization\b",
    r"\btelemetry\b",
    r"\bstorage\b",
    r"\bcompute\b",
    r"\bnetwork\b",
]

NOT_SOFTWARE = [
    r"\bhardware engineer\b",
    r"\bmechanical engineer\b",
    r"\bpcb design engineer\b",
    r"\belectrical(?:\s+controls)? engineer\b",
    r"\bcivil engineer\b",
    r"\bchemical engineer\b",
    r"\baerospace engineer\b",
    r"\bpropulsion engineer\b",
    r"\bfield service engineer\b",
    r"\bmanufacturing engineer\b",
    r"\bindustrial engineer\b",
    r"\bcontrols engineer\b",
    r"\bhvac engineer\b",
    r"\bstructural engineer\b",
]

SOFTWARE_AFTER_ALL = [
    r"\bsoftware\b",
    r"\bfront(?:\s|-)?end\b",
    r"\bback(?:\s|-)?end\b",
    r"\bfull.?stack\b",
    r"\bweb\s+dev(?:eloper|elopment)?\b",
    r"\bmobile\b",
    r"\bios\b",
    r"\bandroid\b",
    r"\bfirmware\b",
    r"\bembedded(?:\s+software)?\b",
    r"\bdevops\b",
    r"\bcloud\b",
    r"\bplatform engineer\b",
    r"\bsite reliability\b",
    r"\bsre\b",
    r"\bml engineer\b",
    r"\bai engineer\b",
    r"\bdata engineer\b",
    r"\bcomputer vision\b",
    r"\bnlp\b",
    r"\bmachine learning\b",
]
