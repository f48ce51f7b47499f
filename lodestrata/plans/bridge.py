"""Source-shaped tables made from the star-schema tables.

The test tables hold no source code, so each statement here builds files, components, edges,
flows or texts from them. Every statement reads alike in Spark and in DuckDB, and so feeds a
query and its oracle with the same rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lodestrata.sources.shared import parts_for

NL = "chr(10)"


def _text(*parts: str) -> str:
    return "concat(" + ", ".join(parts) + ")"


KEY = "cast(p_partkey as varchar(20))"
SIZE = "cast(p_size as varchar(20))"
SUFFIX = "CASE p_partkey % 9 WHEN 0 THEN 'Service' WHEN 1 THEN 'Controller' WHEN 2 THEN 'Repository' WHEN 3 THEN 'Handler' WHEN 4 THEN 'Dto' WHEN 5 THEN 'Settings' WHEN 6 THEN 'Validator' WHEN 7 THEN 'Exception' ELSE 'Widget' END"
EXTENSION = (
    "CASE p_partkey % 20 WHEN 0 THEN '.cs' WHEN 1 THEN '.cs' WHEN 2 THEN '.razor' WHEN 3 THEN '.json' WHEN 4 THEN '.csproj' WHEN 5 THEN '.js' WHEN 6 THEN '.yml' WHEN 7 THEN '.md' "
    "WHEN 8 THEN '.py' WHEN 9 THEN '.java' WHEN 10 THEN '.min.js' WHEN 11 THEN '.log' WHEN 12 THEN '.g.cs' WHEN 13 THEN '.config' WHEN 14 THEN '.ts' WHEN 15 THEN '.sln' "
    "WHEN 16 THEN '.png' WHEN 17 THEN '.css' WHEN 18 THEN '.cs' ELSE '.txt' END"
)
FOLDER = (
    "CASE p_size % 12 WHEN 0 THEN 'tests/Unit' WHEN 1 THEN 'src/Web/Pages' WHEN 2 THEN 'src/Web/Controllers' WHEN 3 THEN 'src/ApplicationCore/Services' WHEN 4 THEN 'src/Infrastructure/Data' "
    "WHEN 5 THEN 'src/ApplicationCore/Entities' WHEN 6 THEN 'src/PublicApi/CatalogEndpoints' WHEN 7 THEN 'src/bin/Debug' WHEN 8 THEN 'Specifications' WHEN 9 THEN 'infra' "
    "WHEN 10 THEN '.github/workflows' ELSE 'src/node_modules/x' END"
)
NAME = (
    "CASE WHEN p_partkey % 97 = 0 THEN 'Dockerfile' WHEN p_partkey % 89 = 0 THEN 'package.json' WHEN p_partkey % 83 = 0 THEN 'appsettings.json' WHEN p_partkey % 79 = 0 THEN 'docker-compose.yml' "
    f"ELSE concat('W', {KEY}, {SUFFIX}, {EXTENSION}) END"
)

#: One row a file: seq, path, name, suffix, size, number of lines.
FILES = f"""SELECT seq, path, name, folder, size_bytes, line_count, lower(path) AS lower_path, lower(name) AS lower_name,
  CASE WHEN strpos_dot > 0 THEN substring(name, length(name) - strpos_dot + 1) ELSE '' END AS suffix
  FROM (SELECT p_partkey AS seq, concat({FOLDER}, '/', {NAME}) AS path, {NAME} AS name, {FOLDER} AS folder, cast(p_size * 100 + p_partkey % 7 as bigint) AS size_bytes,
    CASE WHEN p_partkey % 13 = 0 THEN NULL ELSE cast(p_size * 3 as bigint) END AS line_count,
    CASE WHEN instr(reverse({NAME}), '.') > 0 THEN instr(reverse({NAME}), '.') ELSE 0 END AS strpos_dot FROM <<part>>) f0"""

#: One row a component; names repeat over files.
COMPONENTS = f"""SELECT p_partkey AS seq, concat('W', cast(p_partkey % 600 as varchar(20)), {SUFFIX}) AS name, concat({FOLDER}, '/', {NAME}) AS file,
  CASE p_size % 8 WHEN 0 THEN 'Controller' WHEN 1 THEN 'Service' WHEN 2 THEN 'Repository' WHEN 3 THEN 'Entity' WHEN 4 THEN 'DTO' WHEN 5 THEN 'FrontendComponent' WHEN 6 THEN 'Configuration' ELSE 'Unknown' END AS component_type,
  CASE p_size % 7 WHEN 0 THEN 'Presentation/UI' WHEN 1 THEN 'API' WHEN 2 THEN 'Application' WHEN 3 THEN 'Domain' WHEN 4 THEN 'Infrastructure' WHEN 5 THEN 'DataAccess' ELSE 'CrossCutting' END AS layer,
  CASE WHEN p_partkey % 17 = 0 THEN 'Unknown' ELSE p_brand END AS module, p_type AS project, {FOLDER} LIKE 'tests/%' AS is_test,
  cast(40 + p_size as bigint) AS points, cast(40 + p_size as double) / 100 AS confidence,
  concat('I', p_type, 'Service') AS contract FROM <<part>>"""

#: One row a dependency record: from a component name to a name, alias or unknown.
EDGES = """SELECT l_orderkey * 10 + l_linenumber AS seq, concat('W', cast(l_partkey % 600 as varchar(20)), CASE l_partkey % 9 WHEN 0 THEN 'Service' WHEN 1 THEN 'Controller' WHEN 2 THEN 'Repository' WHEN 3 THEN 'Handler' WHEN 4 THEN 'Dto' WHEN 5 THEN 'Settings' WHEN 6 THEN 'Validator' WHEN 7 THEN 'Exception' ELSE 'Widget' END) AS src,
  CASE WHEN l_suppkey % 11 = 0 THEN 'string' WHEN l_suppkey % 7 = 0 THEN concat('I', 'PROMO', 'Service') ELSE concat('W', cast(l_suppkey * 7 % 600 as varchar(20)), CASE l_suppkey * 7 % 9 WHEN 0 THEN 'Service' WHEN 1 THEN 'Controller' WHEN 2 THEN 'Repository' WHEN 3 THEN 'Handler' WHEN 4 THEN 'Dto' WHEN 5 THEN 'Settings' WHEN 6 THEN 'Validator' WHEN 7 THEN 'Exception' ELSE 'Widget' END) END AS dst,
  CASE l_linenumber WHEN 1 THEN 'component_call' WHEN 2 THEN 'constructor_injection' WHEN 3 THEN 'di_registration' WHEN 4 THEN 'mediatr_send' WHEN 5 THEN 'http_client_call' ELSE 'property_injection' END AS kind,
  CASE l_returnflag WHEN 'A' THEN 'calls' WHEN 'N' THEN 'uses' ELSE 'reads' END AS relationship, concat('src/', l_returnflag, '/F', cast(l_suppkey % 40 as varchar(20)), '.cs') AS file,
  cast(l_linenumber * 7 as bigint) AS line, cast(round(100 - l_discount * 100) as bigint) AS points, cast(cast(round(100 - l_discount * 100) as bigint) as double) / 100 AS confidence
  FROM <<lineitem>>"""

#: Module edges: nation of the customer to nation of the supplier, as modules.
MODULE_EDGES = """SELECT DISTINCT concat('M', cast(c_nationkey as varchar(20))) AS src, concat('M', cast(s_nationkey as varchar(20))) AS dst
  FROM <<lineitem>> l JOIN <<orders>> o ON l.l_orderkey = o.o_orderkey JOIN <<customer>> c ON o.o_custkey = c.c_custkey JOIN <<supplier>> s ON l.l_suppkey = s.s_suppkey"""

#: A directed graph for cycles: every part points to parts of its own hundred, from each of its order lines.
DIGRAPH = """SELECT DISTINCT l_partkey AS src, l_partkey - l_partkey % 100 + l_suppkey * 7 % 100 AS dst FROM <<lineitem>> WHERE l_partkey % 100 <> l_suppkey * 7 % 100"""

#: C# source of one file.
CS = f"""SELECT p_partkey AS seq, concat('src/', p_type, '/W', {KEY}, '.cs') AS path, {_text(
    "'namespace App.'", "p_type", "';'", NL, "'using System;'", NL, NL,
    "CASE p_size % 4 WHEN 0 THEN '[Authorize]' WHEN 1 THEN concat('[Authorize(Roles = Admin', " + SIZE + ", ')]') WHEN 2 THEN '[Authorize(Policy)]' ELSE '[Serializable]' END", NL,
    "'[Route(\"api/[controller]\")]'", NL, "'public class W'", KEY, SUFFIX, "' : I'", "p_type", "'Repository, IDisposable'", NL, "'{'", NL,
    "'    private readonly I'", "p_type", "'Service _svc;'", NL,
    "'    public W'", KEY, SUFFIX, "'(I'", "p_type", "'Service svc, ILogger logger)'", NL, "'    {'", NL, "'        _svc = svc;'", NL, "'        Guard.Against.Null(svc);'", NL, "'    }'", NL,
    "'    [Inject]'", NL, "'    public I'", "p_type", "'Store Store { get; set; }'", NL,
    "'    public decimal '", "CASE p_size % 3 WHEN 0 THEN 'TotalPrice' WHEN 1 THEN 'Status' ELSE 'Color' END", "' { get; set; }'", NL,
    "'    [HttpGet(\"items/{id:int}/'", SIZE, "'\")]'", NL,
    "'    public async Task<int> '", "CASE p_size % 6 WHEN 0 THEN 'ApplyDiscount' WHEN 1 THEN 'ValidateOrder' WHEN 2 THEN 'CancelBasket' WHEN 3 THEN 'Render' WHEN 4 THEN 'GetItem' ELSE 'SendMail' END", SIZE, "'(int a, IMediator mediator)'", NL,
    "'    {'", NL, "'        var x = _svc.GetItem(a);'", NL, "'        mediator.Send(new Cmd'", SIZE, "'(a));'", NL, "'        return client.GetAsync(\"/api/'", "p_type", "'\");'", NL, "'    }'", NL, "'}'", NL,
    "'public interface I'", "p_type", "'Repository'", NL, "'{'", NL, "'    int Count'", SIZE, "'(int n);'", NL, "'}'", NL,
    "'public enum Status'", SIZE, "' { Open = 1, Closed, Done'", "p_brand", "' }'", NL)} AS text FROM <<part>>"""

#: Start-up code of one project.
PROGRAM = f"""SELECT p_partkey AS seq, concat('src/', p_type, {KEY}, '/Program.cs') AS path, {_text(
    "'services.AddScoped<I'", "p_type", "'Service, '", "p_type", "'Service>();'", NL, "'builder.Services.AddDbContext<Db'", KEY, "'>();'", NL,
    "'services.AddTransient(typeof(IRepo'", SIZE, "'), typeof(Repo'", SIZE, "'));'", NL,
    "'var api = app.MapGroup(\"/api\");'", NL, "'var v1 = api.MapGroup(\"v'", SIZE, "'/\");'", NL, "'v1.MapGet(\"/items\", Get);'", NL, "'app.MapPost(\"orders/'", SIZE, "'\", Post);'", NL,
    "CASE WHEN p_size % 2 = 0 THEN 'app.MapRazorPages();' ELSE 'app.MapHealthChecks(\"health\");' END", NL, "'app.MapControllerRoute(\"default\", \"{controller}/'", SIZE, "'\");'", NL)} AS text FROM <<part>>"""

JAVA = f"""SELECT p_partkey AS seq, {_text("'public class J'", KEY, "' {'", NL, "'    public int '", "CASE p_size % 3 WHEN 0 THEN 'computeTax' WHEN 1 THEN 'paint' ELSE 'loadAll' END", SIZE, "'(int a) {'", NL, "'        return a;'", NL, "'    }'", NL, "'}'", NL, "'interface K'", SIZE, "' {}'", NL)} AS text FROM <<part>>"""
JS = f"""SELECT p_partkey AS seq, {_text("'export class C'", KEY, "' {}'", NL, "'function save'", SIZE, "'(a) {'", NL, "'}'", NL, "'const load'", SIZE, "' = async (a) => a;'", NL, "'const o = { run'", SIZE, "': function (x) { } };'", NL, "'function save'", SIZE, "'(b) {'", NL, "'}'", NL)} AS text FROM <<part>>"""
DDL = f"""SELECT p_partkey AS seq, concat('db/', {KEY}, '.sql') AS path, {_text("'CREATE TABLE dbo.T'", KEY, "' ('", NL, "'  Id INT NOT NULL PRIMARY KEY,'", NL, "'  Name VARCHAR(20) NULL,'", NL, "'  Amount DECIMAL(10,2),'", NL, "'  CONSTRAINT fk FOREIGN KEY (OrderId) REFERENCES T'", SIZE, "' (Id)'", NL, "');'", NL, "'CREATE PROCEDURE p'", KEY, "' AS SELECT 1;'", NL, "'CREATE VIEW v'", SIZE, "' AS SELECT 1;'", NL, "'CREATE TRIGGER tr'", SIZE, "' ON T'", KEY, NL)} AS text FROM <<part>>"""
EF = f"""SELECT p_partkey AS seq, {_text("'public DbSet<E'", SIZE, "'> Items { get; set; }'", NL, "'modelBuilder.Entity<F'", SIZE, "'>();'", NL, "'[Table(\"t'", SIZE, "'\")]'", NL)} AS text FROM <<part>>"""
CONF = f"""SELECT p_partkey AS seq, concat('conf/', {KEY}, '.properties') AS path, {_text("'# note'", NL, "'max_size='", SIZE, NL, "'db.password = x=y '", NL, "'plain'", NL, "'feature-flag-'", SIZE, "'=on'", NL, "'user.role=admin'", NL)} AS text FROM <<part>>"""
COMPOSE = f"""SELECT p_partkey AS seq, concat('deploy/', {KEY}, '/docker-compose.yml') AS path, {_text("'version: 3'", NL, "'  early:'", NL, "'services:'", NL, "'  web'", SIZE, "':'", NL, "'    image: a'", NL, "'  db.'", KEY, "':  '", NL, "'    ports:'", NL)} AS text FROM <<part>>"""
RAZOR = f"""SELECT p_partkey AS seq, concat('src/Web/Pages/', p_type, '/', CASE WHEN p_size % 5 = 0 THEN 'Index' ELSE concat('P', {KEY}) END, '.razor') AS path, {_text("CASE WHEN p_size % 2 = 0 THEN concat('@page \"/r/', " + SIZE + ", '\"') ELSE '@page' END", NL, "'@inject I'", "p_type", "'Service Svc'", NL, "'@inherits Base'", NL, "'@attribute [Authorize]'", NL, "'<p>x</p>'", NL)} AS text FROM <<part>>"""
#: Log lines, in order.
LOGS = """SELECT event_id AS seq, concat('logs/u', cast(user_id % 14 as varchar(20)), '.log') AS path, concat(CASE WHEN event_id % 4 = 0 THEN '' ELSE 'WARN ' END,
  CASE event_type WHEN 'click' THEN 'order Created by ' WHEN 'purchase' THEN 'payment charged for ' WHEN 'signup' THEN 'user registered as ' WHEN 'error' THEN 'ERROR failed at ' ELSE 'seen ' END, cast(user_id as varchar(20))) AS line FROM <<events>>"""
#: Marked multi-file answers.
MARKED = f"""SELECT p_partkey AS seq, {_text("'intro'", NL, "'===AA_FILE_START:docs/../A'", KEY, "'.md==='", NL, "'body '", "p_name", NL, "'===AA_FILE_END==='", NL, "'===DOCUMENT_START:B'", SIZE, "'.md==='", NL, "'two'", NL, "'===DOCUMENT_END==='", NL)} AS text FROM <<part>>"""
FENCED = f"""SELECT p_partkey AS seq, CASE p_size % 4 WHEN 0 THEN concat('text', {NL}, '```json', {NL}, '{{"a": ', {SIZE}, '}}', {NL}, '```') WHEN 1 THEN concat('```', {NL}, '{{"a": ', {SIZE}, '}}', {NL}, '```') WHEN 2 THEN concat('{{"a": ', {SIZE}, '}}') ELSE 'no json here' END AS text FROM <<part>>"""

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def source(spark: SparkSession, sf_dir: str, statement: str) -> DataFrame:
    """The rows of a statement of this module; only tables that it names are opened."""
    for table in TABLES:
        statement = statement.replace(f"<<{table}>>", f"parquet.`{sf_dir}/{table}.parquet`")
    return spark.sql(statement)


TEXTS_A_PART = 8192
"""Rows of ``part`` whose texts are made in one partition, at most about."""


def texts(spark: SparkSession, sf_dir: str, statement: str) -> DataFrame:
    """``source`` of a statement that makes texts from ``part``: its short rows are dealt out by key before a text is made.

    A table of a few bytes a row is one input split up to millions of rows; without this all their texts would be made and read by one task."""
    table = f"parquet.`{sf_dir}/part.parquet`"
    dealt = parts_for(spark.table(table), TEXTS_A_PART)
    return source(spark, sf_dir, statement.replace("<<part>>", f"(SELECT /*+ REPARTITION({dealt}, p_partkey) */ * FROM {table})"))


def duck(statement: str) -> str:
    """The same statement for DuckDB, where tables are views."""
    for table in TABLES:
        statement = statement.replace(f"<<{table}>>", table)
    return statement
