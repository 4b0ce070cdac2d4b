"""Word lists, patterns and platform schemas. Results depend on each of them."""

from __future__ import annotations

# Words that score a request URL.
PATH_WORDS = (
    "/jobs", "/positions", "/careers", "/openings", "/vacancies", "/postings", "/requisitions", "/roles", "/embed/jobs",
    "/embed/departments", "/departments", "/embedjobs", "/job_openings", "/boards", "/career", "/careerspagequery",
    "/employer", "/get-all-jobs", "/get_job", "/hire", "/hiring", "/job", "/job-board", "/job-posting", "/position_details",
    "/posting-api", "/recruit", "/recruiter", "/reqlist", "/sr-jobs", "/turbohire",
)
PAGING_PARAMS = ("?page=", "&page=", "?offset=", "&offset=", "?limit=", "&limit=", "?department=", "&department=", "?location=", "&location=", "?category=", "&category=")

# Hosts of known hiring platforms.
ATS_DOMAINS = (
    "greenhouse.io", "lever.co", "ashbyhq.com", "ashby.io", "myworkdayjobs.com", "workday.com", "wd1.myworkdayjobs.com",
    "smartrecruiters.com", "bamboohr.com", "jobvite.com", "icims.com", "breezy.hr", "recruitee.com", "teamtailor.com",
    "personio.com", "personio.de", "workable.com", "paylocity.com", "taleo.net", "successfactors.com", "jazzhr.com",
    "pinpointhq.com", "dover.com", "rippling.com", "gusto.com", "rippling-ats.com", "freshteam.com", "ultipro.com",
    "fountain.com", "comeet.co", "traffit.com", "recruitcrm.io", "zohorecruit.com", "keka.com", "darwinbox.com",
    "springrecruit.com", "hirecraft.in", "ceipal.com", "turbohire.co", "aglasem.com", "api.ashbyhq.com", "api.greenhouse.io",
    "api.lever.co", "apply.workable.com", "ashby-job-postings-serverless-function.vercel.app", "asteria.keka.com",
    "bnymellon.eightfold.ai", "eightfold.ai", "boards-api.greenhouse.io", "bounteous.com", "careers.alight.com",
    "careers.atherenergy.com", "careers.cisco.com", "careers.ey.com", "careers.freeagent.com", "careers.humana.com",
    "careers.ixigo.com", "careers.makemytrip.com", "careers.pnc.com", "careers.viasat.com", "careers.yellow.ai",
    "clootrack.freshteam.com", "coforma.pinpointhq.com", "impactanalytics.keka.com", "jarvis-deploy.byteridge.com",
    "jobs.ashbyhq.com", "jobs.booking.com", "jobs.medallia.com", "jobs.smartrecruiters.com", "jobs.twilio.com",
    "jobsapi-internal.m-cloud.io", "khanacademy.org", "khatabook.com", "micron.eightfold.ai", "pleo.io",
    "practo.app.param.ai", "param.ai", "scopicsoftware.zohorecruit.com", "sirion.mynexthire.com", "mynexthire.com",
    "swiggy.mynexthire.com",
)

# Requests that are never job data.
JUNK = (
    "/analytics", "/tracking", "/beacon", "/pixel", "/metrics", "/logs", "/error", "/crash", ".css", ".woff", ".png", ".jpg", ".svg",
    "google-analytics", "segment.io", "hotjar", "intercom", "/auth/token", "/oauth/token", "/login", "/logout",
    "/cdn-cgi", "/healthcheck", "/ping", "cloudflare", "akamai", "fastly",
)

# Keys of job objects in response bodies.
JOB_KEYS = ("jobs", "positions", "openings", "listings", "vacancies")
ATS_VOCABULARY = (
    "title", "location", "department", "description", "apply_url", "application_url", "req_id", "requisition_id",
    "employment_type", "posted_at", "offices", "absolute_url", "updated_at", "data_compliance", "internal_job_id",
)
GENERAL_VOCABULARY = (
    "name", "role", "position", "city", "country", "region", "office", "team", "function", "level", "salary", "compensation",
    "remote", "type", "url", "link", "deadline", "start_date", "experience", "skills", "reqId", "reqTitle", "buName", "statusId",
    "position_id", "req_title", "job_id", "opening_id",
)
LOCATION_FIELDS = ("city", "country", "region")
SINGLE_JOB_FIELDS = (
    "title", "name", "role", "description", "requirements", "responsibilities", "apply_url", "application_url", "location", "city",
    "department", "team", "salary", "compensation", "employment_type", "posted_at", "deadline", "start_date",
)
PAGING_FIELDS = ("total", "count", "totalcount", "total_count", "pagination", "meta", "page", "pages", "per_page", "pagesize")

# Responses whose bodies are not scored.
RESPONSE_DOMAINS = (
    "cookielaw.org", "onetrust.com", "cookiepro.com", "googletagmanager.com", "google-analytics.com", "segment.io", "mixpanel.com",
    "amplitude.com", "hotjar.com", "intercom.io", "contentful.com", "cdn.growthbook.io", "cmp.inmobi.com",
    "cdn.cookie-script.com", "website-files.com",
)
RESPONSE_EXEMPT = ("keka.com", "eightfold.ai", "mynexthire.com", "zohorecruit.com", "param.ai", "freshteam.com", "pinpointhq.com", "smartrecruiters.com", "medallia.com")
RESPONSE_NOISE = ("/lottie/", "/page-data/sq/", "/wp-json/contact-form", "/youtubei/", "/ims/check/", "/v1/open", "/v3/company/details", "helios/page-data")
RESPONSE_JOB_WORDS = ("career", "job", "position", "opening", "hiring")
RESPONSE_EXTENSIONS = (".css", ".js", ".woff", ".woff2", ".png", ".jpg", ".svg")

# Requests that a browser run aborts.
REQUEST_DOMAINS = (
    "google-analytics.com", "googletagmanager.com", "doubleclick.net", "analytics.twitter.com", "facebook.net", "segment.io",
    "segment.com", "mixpanel.com", "hotjar.com", "intercom.io", "fullstory.com", "logrocket.io", "clarity.ms", "launchdarkly.com",
    "optimizely.com", "split.io", "ads.yahoo.com", "criteo.com", "adroll.com", "amazon-adsystem.com", "cookielaw.org",
    "onetrust.com", "axept.io", "cookiebot.com", "quantcast.com", "sentry.io", "bugsnag.com", "newrelic.com", "datadoghq.com", "nr-data.net",
)
REQUEST_EXTENSIONS = (".jpg", ".jpeg", ".png", ".gif", ".webp", ".svg", ".mp4", ".webm", ".ogg", ".mp3", ".wav", ".woff", ".woff2", ".ttf", ".otf", ".eot", ".css")
REQUEST_SEGMENTS = (
    "/analytics", "/telemetry", "/tracking", "/beacon", "/pixel", "/log", "/metrics", "/healthcheck", "/ping", "/auth/token",
    "/oauth", "/feature-flag", "/killswitch", "/initialize", "/config",
)
REQUEST_PARAMS = ("?k=", "?sid=", "?st=", "&k=", "&sid=", "&st=")
REQUEST_EXEMPT = (
    "greenhouse.io", "lever.co", "ashbyhq.com", "ashby.io", "workable.com", "smartrecruiters.com", "bamboohr.com", "jobvite.com",
    "icims.com", "teamtailor.com", "personio.com", "personio.de", "pinpointhq.com", "freshteam.com", "keka.com", "darwinbox.com",
)
BLOCKED_TYPES = ("Image", "Font", "Media", "Stylesheet")
KEPT_TYPES = ("XHR", "Fetch")

# The static score of a URL.
STATIC_PATHS = ("/jobs", "/careers", "/positions", "/openings", "/work-with-us")
STATIC_PREFIXES = ("jobs.", "careers.", "work.", "apply.")
STATIC_ENDINGS = (".io", ".ai", ".co")
STATIC_NOISE = ("/blog", "/press", "/news", "/about", "/legal", "/privacy")

# The 0 to 100 score of a URL.
RANKED_GLOBAL = ("greenhouse.io", "lever.co", "ashbyhq.com", "workable.com", "myworkdayjobs.com", "icims.com", "smartrecruiters.com", "bamboohr.com", "jobvite.com", "taleo.net", "successfactors.com", "pinpointhq.com", "recruitee.com", "teamtailor.com")
RANKED_REGIONAL = ("keka.com", "darwinbox.in", "darwinbox.com", "zohorecruit.com", "springrecruit.com", "zohorecruit.in")

# Hosts that a URL list is cleaned of, by reason.
CLEAN = {
    "aggregator": ("glassdoor", "linkedin", "naukri", "indeed", "adzuna", "monster", "shine.com", "timesjobs", "iimjobs", "ziprecruiter", "simplyhired"),
    "social": ("twitter.com", "facebook.com", "instagram.com", "youtube.com"),
    "government": (".gov", ".gov.in", ".mil", ".ac.in"),
    "redirect": ("bit.ly", "t.co", "goo.gl", "ow.ly", "tinyurl.com", "is.gd", "buff.ly", "lnkd.in"),
}
SOCIAL = ("instagram.com", "facebook.com", "twitter.com", "linkedin.com", "youtube.com", "tiktok.com", "pinterest.com", "x.com", "reddit.com", "snapchat.com", "whatsapp.com")
ARCHIVE_AGGREGATORS = ("linkedin.com", "glassdoor.com", "indeed.com", "naukri.com", "monster.com", "adzuna.com", "ziprecruiter.com")
ARCHIVE_PLATFORMS = (
    ("greenhouse", "greenhouse.io"), ("lever", "lever.co"), ("ashby", "ashbyhq.com"), ("workable", "workable.com"), ("workday", "myworkdayjobs.com"),
    ("icims", "icims.com"), ("smartrecruiters", "smartrecruiters.com"), ("bamboohr", "bamboohr.com"), ("jobvite", "jobvite.com"), ("taleo", "taleo.net"),
    ("successfactors", "successfactors.com"), ("pinpoint", "pinpointhq.com"), ("recruitee", "recruitee.com"), ("teamtailor", "teamtailor.com"),
)
OPERATIONAL_HOSTS = ("www", "api", "app", "developers", "support", "help", "blog", "docs", "status", "careers", "about", "press", "news", "login", "accounts", "dashboard")
SHARED_HOSTS = ("boards", "jobs", "careers", "career", "careers-page")

# Slugs that no company has.
SLUG_EXACT = (
    "www", "mail", "api", "app", "apps", "play", "maps", "docs", "drive", "support", "help", "blog", "shop", "store", "news", "forum",
    "static", "cdn", "media", "images", "staging", "dev", "test", "demo", "sandbox", "preview", "internal", "admin", "login",
    "dashboard", "status", "careers", "about", "boards", "job-boards", "developers", "brand", "press", "accounts", "marketing",
    "sales", "vpn", "proxy", "smtp", "ftp",
)
SLUG_PARTS = ("prod-", "staging-", "dev-", "test-", "uuid", "access-proxy", "use1-", "usw2-", "apse", "euw", "internal-", "infra-", "monitoring", "loadbalancer")
CERTIFICATE_PARTS = ("prod-", "staging", "dev-", "test-", "uuid", "access-proxy", "use1-", "usw2-", "apse", "euw", "internal", "infra", "monitoring", "loadbalancer")
CERTIFICATE_EXACT = (
    "www", "app", "api", "support", "inside", "brand", "grow", "boards", "job-boards", "developers", "help", "docs", "status", "careers",
    "about", "press", "login", "accounts", "dashboard", "blog", "marketing", "sales", "demo", "sandbox", "preview", "cdn", "static",
    "assets", "media", "images", "mail", "smtp", "vpn", "proxy",
)
COMPANY_SUFFIXES = (" inc", " corp", " ltd", " llc", " co", " group", " holdings", " company", " limited")

# Platform by part of a URL, in order; then the same for the migration.
PLATFORM_PARTS = (
    ("greenhouse", "greenhouse"), ("lever.co", "lever"), ("ashbyhq", "ashby"), ("workable", "workable"), ("bamboohr", "bamboohr"), ("recruitee", "recruitee"),
    ("teamtailor", "teamtailor"), ("rippling", "rippling"), ("pinpointhq", "pinpoint"), ("freshteam", "freshteam"), ("smartrecruiters", "smartrecruiters"),
    ("jobvite.com", "jobvite"), ("breezy.hr", "breezyhr"), ("personio.", "personio"),
)
MIGRATED_PARTS = (
    ("greenhouse.io", "greenhouse"), ("lever.co", "lever"), ("ashbyhq.com", "ashbyhq"), ("workable.com", "workable"), ("bamboohr.com", "bamboohr"),
    ("recruitee.com", "recruitee"), ("teamtailor.com", "teamtailor"), ("rippling.com", "rippling"), ("pinpointhq.com", "pinpointhq"),
    ("freshteam.com", "freshteam"), ("smartrecruiters.com", "smartrecruiters"),
)
#: Registry names of platforms that other steps call otherwise.
PLATFORM_ALIASES = {"pinpoint": "pinpointhq"}

# Where a slug stands on each platform, as a format.
PLATFORM_DOMAINS = {
    "greenhouse": "%s.greenhouse.io", "lever": "jobs.lever.co/%s", "ashby": "jobs.ashbyhq.com/%s", "workable": "%s.workable.com", "bamboohr": "%s.bamboohr.com",
    "recruitee": "%s.recruitee.com", "teamtailor": "%s.teamtailor.com", "pinpoint": "%s.pinpointhq.com", "freshteam": "%s.freshteam.com", "rippling": "%s-careers.rippling.com",
    "smartrecruiters": "smrtr.io/%s", "jobvite": "jobs.jobvite.com/company/%s", "breezyhr": "%s.breezy.hr", "personio": "%s.jobs.personio.com",
}
PLATFORM_ENDPOINTS = {
    "greenhouse": "https://boards-api.greenhouse.io/v1/boards/%s/jobs", "lever": "https://api.lever.co/v0/postings/%s?mode=json&limit=5",
    "workable": "https://apply.workable.com/api/v3/accounts/%s/jobs", "bamboohr": "https://%s.bamboohr.com/jobs/embed2.php", "recruitee": "https://%s.recruitee.com/api/offers",
    "teamtailor": "https://jobs.teamtailor.com/companies/%s/jobs.json", "rippling": "https://api.rippling.com/platform/api/ats/v1/board/%s-careers/jobs",
    "pinpoint": "https://%s.pinpointhq.com/postings.json", "freshteam": "https://%s.freshteam.com/hire/widgets/jobs.json",
    "smartrecruiters": "https://api.smartrecruiters.com/v1/companies/%s/postings", "jobvite": "https://jobs.jobvite.com/api/job?c=%s",
    "breezyhr": "https://api.breezy.hr/v3/company/%s/positions?state=published", "personio": "https://%s.jobs.personio.com/api/v1/jobs",
}

# Slugs in the links of a page, by platform.
LINK_PATTERNS = (
    ("greenhouse", "greenhouse.io", r"(?:boards\.greenhouse\.io|boards-api\.greenhouse\.io/v1/boards)/([a-zA-Z0-9_-]+)"),
    ("lever", "lever.co", r"(?:jobs\.lever\.co|api\.lever\.co/v0/postings)/([a-zA-Z0-9_-]+)"),
    ("workday", "myworkdayjobs.com", r"([a-zA-Z0-9_-]+)\.wd\d+\.myworkdayjobs\.com(?:/.*?/([a-zA-Z0-9_-]+))?"),
    ("smartrecruiters", "smartrecruiters.com", r"(?:careers\.smartrecruiters\.com|api\.smartrecruiters\.com/v1/companies)/([a-zA-Z0-9_-]+)"),
    ("ashby", "ashbyhq.com", r"(?:jobs\.ashbyhq\.com|api\.ashbyhq\.com/posting-api/job-board)/([a-zA-Z0-9_-]+)"),
    ("recruitee", "recruitee.com", r"([a-zA-Z0-9_-]+)\.recruitee\.com"),
    ("pinpoint", "pinpointhq.com", r"([a-zA-Z0-9_-]+)\.pinpointhq\.com"),
    ("freshteam", "freshteam.com", r"([a-zA-Z0-9_-]+)\.freshteam\.com"),
    ("rippling", "rippling.com", r"([a-zA-Z0-9_-]+)(?:-careers)?\.rippling\.com"),
    ("teamtailor", "teamtailor.com", r"([a-zA-Z0-9_-]+)\.teamtailor\.com"),
    ("jobvite", "jobvite.com", r"jobs\.jobvite\.com/(?:company/|.*?c=)([a-zA-Z0-9_-]+)"),
    ("breezyhr", "breezy.hr", r"([a-zA-Z0-9_-]+)\.breezy\.hr"),
    ("personio", "personio.", r"([a-zA-Z0-9_-]+)\.jobs\.personio\.(?:com|de)"),
    ("workable", "workable.com", r"(?:apply\.workable\.com/|jobs\.workable\.com/)([a-zA-Z0-9_-]+)"),
    ("bamboohr", "bamboohr.com", r"([a-zA-Z0-9_-]+)\.bamboohr\.com"),
)
LINKS = r"""(?i)(?:href|src|action)\s*=\s*["']([^"']+)["']"""
REDIRECTS = r"""(?i)(?:window\.location|location\.href)\s*=\s*["']([^"']+)["']"""

# Endpoints in a page's text, in order: name, method, pattern, whether a path is taken from the domain.
ENDPOINTS = (
    ("greenhouse", "GET", r"""(?i)(https?://boards-api\.greenhouse\.io/v1/boards/[a-z0-9_-]+/jobs[^"'\s]*)""", False),
    ("lever", "GET", r"""(?i)(https?://api\.lever\.co/v0/postings/[a-z0-9_-]+[^"'\s]*)""", False),
    ("workday", "GET", r"""(?i)"(https?://[^"]+\.myworkdayjobs\.com/[^"]+/jobs[^"]*)\"""", False),
    ("ashby", "GET", r"""(?i)(https?://api\.ashbyhq\.com/posting-api/job-board/[a-z0-9_-]+)""", False),
    ("generic_api", "GET", r"""(?i)["'](/?api/v?\d*/(?:jobs|positions|openings|careers)[^"'\s]*)["']""", True),
    ("graphql", "POST", r"""(?i)["'](/?graphql[^"'\s]*)["']""", True),
    ("smartrecruiters", "GET", r"""(?i)(https?://api\.smartrecruiters\.com/v1/companies/[^"'\s]+/postings[^"'\s]*)""", False),
    ("bamboohr", "GET", r"""(?i)(https?://[^"']+\.bamboohr\.com/api/gateway\.php/[^"'\s]+/v1/applicant_tracking/jobs[^"'\s]*)""", False),
    ("jobvite", "GET", r"""(?i)(https?://[^"'\s]+jobvite\.com/api/website/jobs[^"'\s]*)""", False),
    ("icims", "GET", r"""(?i)(https?://[^"'\s]+\.icims\.com/jobs/[^"'\s]*)""", False),
)
PRECONNECT = r"""(?i)<link[^>]+rel=["']preconnect["'][^>]+href=["'](https?://[^"']+(?:greenhouse|lever|ashby|workday|smartrecruiters|bamboohr|jobvite|icims|teamtailor|personio|workable)[^"']*)["']"""
PAYLOAD_HOSTS = ("boards-api.greenhouse.io", "api.lever.co", "api.ashbyhq.com", "api.smartrecruiters.com", "api.jobvite.com", "myworkdayjobs.com", "bamboohr.com", "icims.com", "api.teamtailor.com", "api.personio.de", "api.workable.com")
PAYLOAD_PATHS = ("/api/jobs", "/api/careers", "/api/positions", "/jobs/search", "/graphql")
POLICY_HOSTS = ("greenhouse.io", "lever.co", "ashbyhq.com", "ashby.io", "smartrecruiters.com", "bamboohr.com", "jobvite.com", "icims.com", "teamtailor.com", "personio.de", "workable.com", "myworkdayjobs.com")

# What purging treats as false positives.
FALSE_POSITIVES = ("cookielaw.org", "statuspage.io", "cognito-identity", "onetrust.com", "killswitch", "initialize?k=", "global-elements", "graphql.contentful.com", "coc_event", "KillSwitches", "globalSettings")

# Aliases by which a job field is found, first hit first.
JOB_ARRAYS = ("jobs", "postings", "data", "results", "items", "positions", "openings", "vacancies", "requisitions")
FIELD_ALIASES = {
    "external_job_id": ("id", "req_id", "jobId", "job_id", "requisitionId", "externalId"),
    "title": ("title", "job_title", "jobTitle", "name", "position"),
    "location": ("location", "office", "city", "workplaceType", "locationName"),
    "apply_url": ("applyUrl", "apply_url", "url", "jobUrl", "hostedUrl", "absoluteUrl"),
    "salary_raw": ("salary", "compensation", "salaryRange"),
    "posted_raw": ("posted_at", "postedAt", "createdAt", "updatedAt", "pubDate"),
}
SALARY = r"([\$£€¥]|USD|EUR|GBP|INR)?[\s]*([\d,]+)[\s]*(?:-|to)?[\s]*([\d,]+)?"

_ENGLISH = {"FullTime": "full_time", "PartTime": "part_time", "Contract": "contract", "Intern": "internship"}
_ASHBY = {"jobs_path": "data.jobBoardWithTeams.jobPostings", "external_id": "id", "title": "title", "location_raw": "locationName", "department": "teamName", "employment_type": "employmentType", "is_remote": "isRemote", "apply_url": "jobUrl", "employment_types": _ENGLISH, "remote_values": ("true",)}
# Where each platform keeps the fields of a job. A new platform is a new entry.
SCHEMAS = {
    "jobvite": {"jobs_path": "reqList", "external_id": "id", "title": "title", "location_raw": "jobRegion", "city": "jobRegion", "department": "jobCategory", "employment_type": "jobType", "apply_url": "applyLink", "posted_at": "publishedDate", "posted_format": "unix_ms", "employment_types": {"Full-Time": "full_time", "Part-Time": "part_time", "Contract": "contract", "Intern": "internship"}},
    "breezyhr": {"jobs_path": "", "external_id": "_id", "title": "name", "location_raw": "location.name", "city": "location.city", "country_code": "location.country.id", "department": "department.name", "employment_type": "type.id", "is_remote": "location.is_remote", "apply_url": "url", "remote_values": ("true", "remote"), "employment_types": {"full_time": "full_time", "part_time": "part_time", "contract": "contract", "internship": "internship", "temporary": "contract"}},
    "personio": {"jobs_path": "", "external_id": "id", "title": "name", "location_raw": "office", "department": "department", "employment_type": "employment_type", "apply_url": "url", "id_is_int": True, "employment_types": {"full-time": "full_time", "part-time": "part_time", "intern": "internship", "freelance": "contract"}},
    "greenhouse": {"jobs_path": "jobs", "external_id": "id", "title": "title", "location_raw": "location.name", "department": "departments[0].name", "apply_url": "absolute_url", "posted_at": "first_published", "posted_format": "rfc3339", "id_is_int": True},
    "lever": {"jobs_path": "", "external_id": "id", "title": "text", "location_raw": "categories.location", "department": "categories.team", "employment_type": "categories.commitment", "apply_url": "applyUrl", "posted_at": "createdAt", "posted_format": "unix_ms", "employment_types": {"Full-time": "full_time", "Full Time": "full_time", "Fulltime": "full_time", "Part-time": "part_time", "Part Time": "part_time", "Contract": "contract", "Contractor": "contract", "Internship": "internship", "Intern": "internship"}},
    "ashby": _ASHBY,
    "ashbyhq": _ASHBY,
    "recruitee": {"jobs_path": "offers", "external_id": "id", "title": "title", "location_raw": "location", "department": "department", "is_remote": "remote", "apply_url": "url", "id_is_int": True, "remote_values": ("true",)},
    "freshteam": {"jobs_path": "jobs", "external_id": "id", "title": "title", "is_remote": "remote", "apply_url": "url", "posted_at": "created_at", "posted_format": "rfc3339", "id_is_int": True, "remote_values": ("true",), "lookups": (("branch_id", "branches", {"city": "city", "country_code": "country_code", "location_raw": "location"}), ("job_role_id", "job_roles", {"department": "name"}))},
    "pinpointhq": {"jobs_path": "data", "external_id": "id", "title": "title", "location_raw": "location.name", "city": "location.city", "country_code": "location.country_code", "department": "job.department.name", "employment_type": "employment_type", "is_remote": "workplace_type", "apply_url": "url", "remote_values": ("remote", "fully_remote")},
    "rippling": {"jobs_path": "", "external_id": "uuid", "title": "name", "location_raw": "workLocation.label", "department": "department.label", "apply_url": "url", "employment_type": "employmentType", "employment_types": {"FULL_TIME": "full_time", "PART_TIME": "part_time", "CONTRACTOR": "contract", "INTERN": "internship"}},
    "teamtailor": {"jobs_path": "data", "external_id": "id", "title": "attributes.title", "is_remote": "attributes.remote-status", "description": "attributes.pitch", "apply_url": "links.careersite-job-url", "remote_values": ("fully-remote", "remote")},
    "workable": {"jobs_path": "results", "external_id": "id", "title": "title", "city": "location.city", "country_code": "location.countryCode", "department": "department[0]", "is_remote": "remote", "posted_at": "published", "posted_format": "rfc3339", "id_is_int": True, "remote_values": ("true",), "apply_url": "url", "employment_type": "employment_type", "employment_types": _ENGLISH},
    "smartrecruiters": {"jobs_path": "content", "external_id": "id", "title": "name", "city": "location.city", "country_code": "location.country.code", "department": "department.label", "employment_type": "typeOfEmployment.label", "employment_types": {"Full-time": "full_time", "Part-time": "part_time", "Contract": "contract", "Temporary": "contract", "Intern": "internship"}},
}
