"""Word lists, lookup tables and ordered rules that results depend on.

Everything here must equal the published behaviour of the analysis, so it is stated as plain
data, together and in the order in which rules apply.
"""

# Names that mark a method as business logic.
BUSINESS_KEYWORDS = (
    "validate validation verify check calculate calculation compute process apply execute handle create update delete save submit approve reject deny authorize "
    "notify send dispatch publish evaluate assess determine place cancel confirm complete assign allocate reserve charge refund discount price register enroll "
    "subscribe login logout authenticate generate build transform convert import export sync migrate total remove transfer aggregate add seed"
).split()

# Business categories, first match wins.
BUSINESS_CATEGORIES = {
    "validation": "validate verify check isvalid can is_valid".split(),
    "calculation": "calculate compute sum total price charge discount tax fee cost amount".split(),
    "approval": "approve reject authorize deny review submit".split(),
    "data_operation": "create update delete save insert get find fetch search load read".split(),
    "process": "process execute run apply handle dispatch place cancel confirm complete finish remove transfer aggregate add seed".split(),
    "notification": "notify send email alert message publish".split(),
    "authentication": "login logout authenticate authorize register".split(),
    "transformation": "transform convert map serialize deserialize".split(),
    "integration": "import export sync migrate push pull".split(),
}

# Scan exclusions of the first layer.
EXCLUDED_DIRS = (
    "bin obj dist build out target release debug publish artifacts node_modules vendor packages .nuget bower_components .vs .idea .vscode .git .svn .hg migrations "
    "generated auto-generated scaffolded efmigrations databasemigrations testresults coverage .testresults testoutput __pycache__ temp tmp cache .cache logs log "
    "da-outputs ba_documents aa-outputs architecture-output evidence-packs llm-stages"
).split()
TEST_FRAGMENTS = "test tests spec specs unittest unittests integrationtest integrationtests e2etest e2etests functionaltest".split()
EXCLUDED_SUFFIXES = (
    ".exe .dll .pdb .lib .obj .o .a .so .dylib .min.js .min.css .bundle.js .suo .user .userosscache .userprefs .lock .jpg .jpeg .png .gif .ico .svg .bmp .tiff .pdf "
    ".docx .xlsx .pptx .zip .tar .gz .rar .7z .designer.cs .g.cs .g.i.cs .designer.vb"
).split()
EXCLUDED_NAMES = "package-lock.json yarn.lock poetry.lock packages.lock.json composer.lock desktop.ini thumbs.db .ds_store".split()

# Language by extension, and extensions of each extractor.
LANGUAGE_BY_EXTENSION = {
    ".cs": "dotnet", ".vb": "dotnet", ".csproj": "dotnet", ".vbproj": "dotnet", ".sln": "dotnet", ".java": "java", ".py": "python", ".js": "javascript", ".ts": "javascript",
    ".jsx": "javascript", ".tsx": "javascript", ".cbl": "cobol", ".cob": "cobol", ".cpy": "cobol", ".php": "php", ".rb": "ruby", ".go": "go", ".kt": "kotlin", ".swift": "swift", ".rs": "rust",
}
EXTRACTOR_EXTENSIONS = {"dotnet": [".cs", ".vb"], "java": [".java"], "python": [".py"], "javascript": [".js", ".ts", ".jsx", ".tsx"], "cobol": [".cbl", ".cob", ".cpy"]}
LANGUAGE_THRESHOLD = 5.0

# Languages of the inventory, by file name and by suffix.
INVENTORY_BY_NAME = {".dockerignore": "docker_ignore", ".editorconfig": "editorconfig", ".gitattributes": "git_attributes", ".gitignore": "git_ignore", "Dockerfile": "dockerfile", "Jenkinsfile": "jenkins"}
INVENTORY_BY_SUFFIX = {
    ".bicep": "bicep", ".config": "xml", ".cs": "csharp", ".cshtml": "razor", ".csproj": "msbuild", ".css": "css", ".dcproj": "msbuild", ".editorconfig": "editorconfig",
    ".gitattributes": "git_attributes", ".gitignore": "git_ignore", ".html": "html", ".ico": "image", ".jpeg": "image", ".jpg": "image", ".js": "javascript", ".json": "json",
    ".md": "markdown", ".png": "image", ".props": "msbuild", ".razor": "razor", ".runsettings": "xml", ".sln": "dotnet_solution", ".svg": "svg", ".targets": "msbuild",
    ".txt": "text", ".xml": "xml", ".yaml": "yaml", ".yml": "yaml",
}
IGNORED_DIRECTORIES = "bin build coverage dist generated logs node_modules obj target vendor .vscode".split()
BUILD_FILES = (
    "angular.json build.gradle composer.json Directory.Packages.props docker-compose.dcproj docker-compose.override.yml docker-compose.yml Everything.sln global.json "
    "package.json pom.xml pyproject.toml requirements.txt settings.gradle"
).split()
DEPLOYMENT_FILES = "azure-pipelines.yml azure.yaml docker-compose.override.yml docker-compose.yml Dockerfile Jenkinsfile".split()
BUILD_SUFFIXES = ".sln .csproj .dcproj .props .targets".split()

# Configuration files and their parameters.
CONFIG_NAMES = (
    "appsettings.json appsettings.development.json appsettings.production.json appsettings.staging.json appsettings.test.json appsettings.local.json web.config app.config "
    "settings.json configuration.json config.json .env .env.development .env.production .env.staging application.properties application.yml application.yaml bootstrap.yml bootstrap.yaml"
).split()
CONFIG_EXTENSIONS = ".json .xml .yml .yaml .properties .config".split()
CONFIG_BUSINESS = (
    "max min limit threshold rate percent percentage approval discount tax fee timeout retry attempt enable disable flag active allowed blocked price cost amount balance "
    "credit debit expiry expire days hours period role permission access level tier batch size count capacity quota smtp email notify alert"
).split()
SENSITIVE = "password secret key token credential pwd pass auth private certificate cert apikey api_key connectionstring".split()
REDACTED = "***REDACTED***"

# Verbs and levels of log lines.
LOG_ACTIONS = (
    "Created Updated Deleted Approved Rejected Validated Processed Submitted Confirmed Cancelled Completed Failed Started Finished Authenticated Authorized Registered "
    "Assigned Dispatched Sent Imported Exported Synced Calculated Charged Refunded Allocated"
).split()
LOG_LEVELS = "INFO DEBUG WARN WARNING ERROR FATAL TRACE CRITICAL".split()
LOG_ERRORS = "ERROR EXCEPTION FATAL CRITICAL UNHANDLED".split()

# Component types by architecture significance.
MAJOR_TYPES = "Controller Service Repository ExternalClient Gateway Middleware Handler ScheduledJob MessageConsumer BatchJob".split()
SUPPORTING_TYPES = "Entity DTO Mapper Validator Configuration FrontendComponent FrontendService RouteGuard StateStore".split()

PRIMITIVE_TYPES = "ActionResult bool byte CancellationToken char DateTime decimal double float Guid IActionResult IEnumerable IResult int long object short string Task uint ulong void".split()

# Names before a dot that are no component: of statics and of a request in methods, and in a type's body elsewhere.
IGNORED_STATIC_TARGETS = "Array Convert Console DateTime Enum Guid JsonSerializer Math Path Results StringComparer Task".split()
IGNORED_INSTANCE_TARGETS = "HttpContext ModelState Request Response User".split()
IGNORED_BODY_TARGETS = "Task Math Guid DateTime JsonSerializer Enum Results Console Path Convert StringComparer".split()

DTO_SUFFIXES = "Dto DTO Request Response Result ViewModel Model".split()
DEPENDENCY_HINTS = "Client Context Gateway Logger Manager Mapper Mediator Repository Sender Service Store".split()

# Folder and name words that name no module.
GENERIC_FOLDERS = (
    "src source test tests pages page controllers controller endpoints endpoint services service repositories repository models model viewmodels views components component "
    "features helpers configuration config middleware data entities entity interfaces shared common core application domain infrastructure web api client server wwwroot properties"
).split()
GENERIC_SUFFIX = "(Controller|Endpoint|Service|Repository|Handler|Dto|DTO|Request|Response|ViewModel|Model|Configuration|Config|Middleware|Validator|Page|Component|Test|Tests)$"
GENERIC_VERB = "^(Get|List|Create|Update|Delete|Remove|Add|Edit|Set|Read|Write|Post|Put|Patch|Search|Find)(By|For|With)?([A-Z])"
CHUNK_SKIP_FOLDERS = "src main java kotlin lib app source sources code module modules".split()

# Modules by words of a component's name, namespace and path, first match wins.
SEMANTIC_MODULES = {
    "Catalog": "catalog catalogaggregate catalogbrand catalogbrands catalogitem catalogitems catalogtype catalogtypes product products".split(),
    "Basket": "basket basketaggregate basketitem basketitems checkout cart".split(),
    "Order": "order orders orderaggregate orderitem orderitems buyer buyeraggregate payment paymentmethod address".split(),
    "Identity": "identity auth authenticate authorization account login logout register manage user token claims".split(),
    "Admin": "admin blazoradmin".split(),
    "SharedContracts": "shared blazorshared contract contracts".split(),
}
DATA_ACCESS_WORDS = "data dbcontext repository context migration migrations seed".split()

# Words of module names that name no capability.
GENERIC_TOKENS = (
    "api app base blazor client component config configuration controller create custom delete default details dto edit endpoint endpoints external functional generate get "
    "handler helper helpers id imports index item items layout list model models page pages public query request response src start service services shared test tests type "
    "types update view views web"
).split()

# File names that tell how a system is built and run, and folders that are read whole.
CONTEXT_FILES = (
    "package[.]json", "package-lock[.]json", ".*[.]csproj", ".*[.]sln", "pom[.]xml", "build[.]gradle([.]kts)?", "requirements.*[.]txt", "pyproject[.]toml", "go[.]mod", "gemfile", "dockerfile.*",
    "docker-compose.*[.]ya?ml", ".*[.]tf", ".*[.]tfvars", "(deployment|service|ingress|configmap|statefulset|daemonset|job|cronjob).*[.]ya?ml", "jenkinsfile", "azure-pipelines[.]ya?ml", "[.]gitlab-ci[.]ya?ml",
    "bitbucket-pipelines[.]ya?ml", "appsettings.*[.]json", "application.*[.](yml|yaml|properties)", "[.]env([.]example|[.]sample)?", "nginx.*[.]conf", "web[.]config",
)
CONTEXT_FOLDERS = ".github .circleci k8s kubernetes manifests terraform infra infrastructure helm".split()
