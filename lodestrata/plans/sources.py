"""Queries of code facts and of structured sources.

The texts are made from rows of ``part``; their oracles are written by hand from what was put into
the texts, and share no rule, pattern or parser with the queries.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestrata.functions import parsers
from lodestrata.functions.rules import quote as q
from lodestrata.operators import aggregates as A
from lodestrata.operators import classify as C
from lodestrata.operators.code import Code, matching_brace, parameters, split_commas
from lodestrata.operators import extract as X
from lodestrata.plans import bridge as B
from lodestrata.plans.catalog import register
from lodestrata.sources import files as S
from lodestrata.sources import named_files as N
from lodestrata.sources.shared import cut

KEY, SIZE = B.KEY, B.SIZE


def made(*parts: str) -> str:
    """A SQL expression of a text: lines as they are, with <key> and <size> for the row's values."""
    text = "\n".join(parts)
    shown = q(text).replace("<key>", f"', {KEY}, '").replace("<size>", f"', {SIZE}, '").replace("\n", "', chr(10), '").replace("\\", "', chr(92), '")
    return f"concat({shown})"


def expected(*rows: str) -> str:
    """One row of each kind for every part: SELECT lists, with <key> and <size> inside quoted text."""
    out = []
    for row in rows:
        row = row.replace("<key>", f"' || {KEY} || '").replace("<size>", f"' || {SIZE} || '")
        out.append(f"SELECT p_partkey AS seq, {row} FROM part")
    return " UNION ALL ".join(out)


CONTROLLER = made(
    "namespace App;", "", '[Area("zone<size>")]', '[Route("api/[controller]")]', "public class W<key>Controller : ControllerBase, IDisposable", "{",
    "    private readonly IOrderService _orders;", "    private readonly ICache<int> _cache;", "    public W<key>Controller(IOrderService orders,", "        IMediator mediator)", "    {", "        _orders = orders;", "    }",
    "    [Inject]", "    public IStore Store { get; set; }", "", '    [HttpGet("items/{id:int}/<size>")]', '    [HttpPost ( "items" )]', '    [Route("unused")]', "    public async Task<int> Find(int id, IMediator mediator, ICatalogService catalog)", "    {",
    "        var made = new Basket<size>(id);", "        var x = _orders.Load(id);", "        catalog.Fetch (id); made.Fill(1);", "        Task.Run(id); Helper.Check(\"}\");", "        mediator.Send(new FindQuery<size>(id));", "        other.Send(new Later(id));", "        _cache.Send(new Never(id));",
    '        http.HttpGet<Item>("api/items/<size>");', "        client.PostAsync(url<size>, body);", "    }", "", "    [HttpDelete]", '    [Route("gone/[action]")]', "    public void Drop(string s, OrderDto dto) { }", "    [HttpPatch]", "    public int Plain() { return 1; }", "}", "",
    "public class Spare<key>", "{", "    private readonly IStore _store;", "    int n = _store.Count(1);", "}",
)
CONTROLLER_CODE = f"SELECT p_partkey AS seq, concat('src/Web/W', {KEY}, 'Controller.cs') AS path, {CONTROLLER} AS text FROM <<part>>"
STARTUP = made(
    "using App;", 'var a = app.MapGroup("/api<size>");', 'var b = a.MapGroup ( "/v1/" );', 'c = b.MapGroup(@"shop");', 'var d = c.MapGroup( $"deep");', 'var e=d.MapGroup("end");', 'e.MapGet ("/items", List);', 'c.MapPut("<key>/", Put);',
    'app.MapPost( "orders", Post);', 'none.MapDelete("x", Drop);', 'app.MapControllerRoute ("default",', '    "{controller}/<size>");', "app.MapRazorPages ();", "app.MapControllers();", "app.MapEndpoints();", 'app.MapFallbackToFile("index.html");', 'app.MapHealthChecks( "/health<size>" );',
    "services.AddScoped<IRepo<Dictionary<int, Order>>, Repo<int>>();", "builder.Services.AddDbContext<Db<size>> ();", "services.AddSingleton<Only<key>>();", "services.AddTransient( typeof(IRead<>) , typeof(Reader<size>) );", "services.AddOptions<Unused>();",
)
STARTUP_CODE = f"SELECT p_partkey AS seq, concat('src/Api', {KEY}, '/Program.cs') AS path, {STARTUP} AS text FROM <<part>>"


def _facts(key: str, statement: str, rows: Callable[[Code], DataFrame], columns: list[str], oracle: str, keep: bool = False):
    """A query of facts with these columns; ``keep`` where they are of several kinds."""

    @register(key, oracle)
    def plan(spark, sf_dir):
        found = rows(Code(B.texts(spark, sf_dir, statement), keep))
        return found.select("seq", *(F.expr(c.rpartition(" AS ")[0] or c).alias(c.rpartition(" AS ")[2]) for c in columns))

    return plan


BASES, LISTED, PARAMETERS = "array_join(bases, ',') AS bases", "array_join(attributes, ';') AS attributes", "array_join(transform(params, p -> concat(p.type, ' ', p.name)), ',') AS parameters"

_facts("code_types", CONTROLLER_CODE, lambda c: c.types, ["owner AS name", "kind", BASES, LISTED, "line"], expected(
    "'W<key>Controller' AS name, 'class' AS kind, 'ControllerBase,IDisposable' AS bases, '[Area(\"zone<size>\")];[Route(\"api/[controller]\")]' AS attributes, 5 AS line", "'Spare<key>', 'class', '', '', 40"))
_facts("program_types", STARTUP_CODE, lambda c: c.types, ["owner AS name", "kind", "line"], expected("'Program' AS name, 'top-level-statements' AS kind, 1 AS line"))
_facts("type_members", CONTROLLER_CODE, lambda c: c.methods, ["owner", "member AS name", "returns", PARAMETERS, "line"], expected(
    "'W<key>Controller' AS owner, 'Find' AS name, 'Task' AS returns, 'int id,IMediator mediator,ICatalogService catalog' AS parameters, 20 AS line", "'W<key>Controller', 'Drop', 'void', 'string s,OrderDto dto', 35", "'W<key>Controller', 'Plain', 'int', '', 37"))
_facts("dependency_facts", CONTROLLER_CODE, Code.dependencies, ["source", "name", "type", "method", "confidence"], expected(
    "'constructor' AS source, 'orders' AS name, 'IOrderService' AS type, NULL AS method, 0.9::DOUBLE AS confidence", "'constructor', 'mediator', 'IMediator', NULL, 0.9", "'property_injection', 'Store', 'IStore', NULL, 0.9",
    "'method_parameter', 'mediator', 'IMediator', 'Find', 0.76", "'method_parameter', 'catalog', 'ICatalogService', 'Find', 0.76"))
_facts("call_facts", CONTROLLER_CODE, Code.calls, ["owner", "source_method", "target", "type", "method", "line"], expected(
    "'W<key>Controller' AS owner, 'Find' AS source_method, '_orders' AS target, 'IOrderService' AS type, 'Load' AS method, 23 AS line", "'W<key>Controller', 'Find', 'catalog', 'ICatalogService', 'Fetch', 24", "'W<key>Controller', 'Find', 'made', 'Basket<size>', 'Fill', 24",
    "'W<key>Controller', 'Find', 'Helper', 'Helper', 'Check', 25", "'W<key>Controller', 'Find', 'mediator', 'IMediator', 'Send', 26", "'W<key>Controller', 'Find', '_cache', 'ICache', 'Send', 28", "'Spare<key>', NULL, '_store', 'IStore', 'Count', 43"))
_facts("send_facts", CONTROLLER_CODE, Code.sends, ["source_method", "target", "type", "request", "line"], expected(
    "'Find' AS source_method, 'mediator' AS target, 'IMediator' AS type, 'FindQuery<size>' AS request, 26 AS line", "'Find', 'other', 'IMediator', 'Later', 27"))
_facts("http_call_facts", CONTROLLER_CODE, Code.http_calls, ["kind", "target", "method", "address AS path", "line", "confidence"], expected(
    "'api_call' AS kind, 'http' AS target, 'GET' AS method, 'api/items/<size>' AS path, 29 AS line, 0.78::DOUBLE AS confidence", "'http_client_call', 'client', 'POST', 'url<size>', 30, 0.5"))
_facts("called_services", CONTROLLER_CODE, Code.called_services, ["owner", "member", "services"], expected("'W<key>Controller' AS owner, 'Find' AS member, 'ICache.Send,IOrderService.Load' AS services"))
_facts("attribute_route_facts", CONTROLLER_CODE, Code.attribute_routes, ["action", "method", "route AS path", "line", "confidence"], expected(
    "'Find' AS action, 'GET' AS method, '/zone<size>/api/W<key>/items/{id}/<size>' AS path, 20 AS line, 0.9::DOUBLE AS confidence", "'Find', 'POST', '/zone<size>/api/W<key>/items', 20, 0.9", "'Drop', 'DELETE', '/zone<size>/api/W<key>/gone/Drop', 35, 0.9",
    "'Plain', 'PATCH', '/zone<size>/api/W<key>', 37, 0.9"))
_facts("mapped_route_facts", STARTUP_CODE, Code.mapped_routes, ["target", "method", "route AS path", "line", "confidence"], expected(
    "'e' AS target, 'GET' AS method, '/api<size>/v1/shop/deep/end/items' AS path, 7 AS line, 0.92::DOUBLE AS confidence", "'c', 'PUT', '/api<size>/v1/shop/<key>', 8, 0.92", "'app', 'POST', '/orders', 9, 0.9", "'none', 'DELETE', '/x', 10, 0.92"))
_facts("framework_route_facts", STARTUP_CODE, Code.framework_routes, ["action", "type", "method", "route AS path", "line"], expected(
    "'ASP.NET conventional MVC route' AS action, 'HTTP_API' AS type, 'unknown' AS method, '/{controller}/<size>' AS path, 11 AS line", "'ASP.NET Razor Pages route registration', 'HTTP_API', 'unknown', 'ASP.NET Razor Pages route registration', 13",
    "'ASP.NET controller route registration', 'HTTP_API', 'unknown', 'ASP.NET controller route registration', 14", "'MinimalApi.Endpoint route registration', 'HTTP_API', 'unknown', 'MinimalApi.Endpoint route registration', 15",
    "'SPA fallback route', 'FrontendRoute', 'unknown', '/index.html', 16", "'ASP.NET health check route', 'HTTP_API', 'GET', '/health<size>', 17"))
_facts("registration_facts", STARTUP_CODE, Code.registrations, ["kind", "lifetime", "service", "implementation", "line", "confidence"], expected(
    "'di_registration' AS kind, 'Scoped' AS lifetime, 'IRepo' AS service, 'Repo' AS implementation, 18 AS line, 0.86::DOUBLE AS confidence", "'db_context_registration', 'DbContext', 'Db<size>', 'Db<size>', 19, 0.86", "'di_registration', 'Singleton', 'Only<key>', 'Only<key>', 20, 0.86",
    "'di_registration', 'Transient', 'IRead', 'Reader<size>', 21, 0.88"))

# Four texts that differ in spacing, nesting and missing parts, by the size of the part: nested types, expression bodies and comments; a body that is
# never closed; attribute routes; start-up code.
NESTED = made(
    "using System;", "namespace A.B", "{", "    /* public class Hidden { } */", '    [ApiController, Route("api/[controller]")]', "    public sealed partial class Outer<key><T>", "        : Base<int, T>, IOuter", "        where T : class, new()", "    {",
    "        private readonly IStore<size> _store; // IGone _gone;", "        private ILogger<Outer<T>> _log = null;", '        public Outer<key>(IStore<size> store) : base("{") => _store = store;', "        public int Sum(int[] xs, Clock clock) => _store.Load(xs) + clock.Now();", "        public abstract void Nothing();",
    "        public async Task<Dictionary<int, string>> Find(", '            [FromQuery] string q = "a,b(",', "            CancellationToken stop = default)", "        {", "            foreach (var x in xs) { Helper", '                .Run(); if (x) { var cart = await new Cart<size>(); cart.Put(@"', 'two lines } _store.Fake(); "); } }',
    "            IRepository repo = Make(); repo.Save(q); Array.Sort(xs); Request.Read();", "        }", "        public class Inner { public void Deep(IMailer m) { m.Send(new Note()); _store.Drop(); } }", "    }", "    interface IOuter { int Sum(int[] xs, Clock clock); string Name { get; } void Reset (); }", "    public record struct Point(int X, int Y);", "    enum Kind { One, Two }", "}",
)
OPEN = made("class Left<key>", "{", "  static int n = Store.Count(1);", "  void Hide() { _x.Do(); Array.Sort(n); User.Go(); }", "  public void Shown() {", "    Store.Run<size>();")
ROUTED = made('[Area("shop<size>")]', "public class CartController", "{", '    [HttpGet][HttpPost("add/{id:int}")]', "    public void Change(int id) { }", "", '    [HttpDeleteAttribute("/gone/")]', "", "    public void Gone() { }", '    [Route("own<key>"), HttpPut]', "    public void Own() { }", "    public void NotAdded() { }", "}", "public class PlainController { [HttpGet] public int List() { return 1; } }")
STARTED = made(
    'var b = WebApplication.Create(); // app.MapGet("no", X);', "builder.Services.AddScoped<IA<B, C<D>>, A<B>>(); services.AddHostedService< Worker<size> >();", "services.AddTransient(typeof(IX<>), typeof(N.X<key>)); services.AddScoped<Open<A>();", 'var g = app.MapGroup($"/api<size>"); var h = g.MapGroup("v1"); g = h.MapGroup("again");',
    'g.MapGet("x/", A); other.MapPost("/y<key>", B); app.MapDelete("z", C);', 'app.MapControllerRoute("n",', '   "{a}/{b}"); app.MapHealthChecks("ok");', "if (x) { app.MapRazorPages(); }",
)
VARIED_CODE = f"SELECT p_partkey AS seq, CASE WHEN p_size % 4 = 3 THEN concat('src/Api', {KEY}, '/Program.cs') ELSE concat('src/F', {KEY}, '.cs') END AS path, CASE p_size % 4 WHEN 0 THEN {NESTED} WHEN 1 THEN {OPEN} WHEN 2 THEN {ROUTED} ELSE {STARTED} END AS text FROM <<part>>"


def varied(columns: str, **rows: list[str]) -> str:
    """``expected`` for the parts of one remainder each: ``of0`` to ``of3``."""
    named = [f"SELECT {columns} FROM (SELECT NULL) z WHERE false"]
    for key, lines in rows.items():
        for line in lines:
            shown = line.replace("<key>", f"' || {KEY} || '").replace("<size>", f"' || {SIZE} || '")
            named.append(f"SELECT p_partkey, {shown} FROM part WHERE p_size % 4 = {key[2:]}")
    return " UNION ALL ".join(named)


_facts("varied_types", VARIED_CODE, lambda c: c.types, ["owner AS name", "kind", BASES, LISTED, "line"], varied(
    "NULL::BIGINT AS seq, '' AS name, '' AS kind, '' AS bases, '' AS attributes, 0 AS line",
    of0=["'Outer<key>', 'class', 'Base<int, T>,IOuter', '[ApiController, Route(\"api/[controller]\")]', 6", "'Inner', 'class', '', '', 24", "'IOuter', 'interface', '', '', 26", "'Point', 'record struct', '', '', 27", "'Kind', 'enum', '', '', 28"],
    of1=["'Left<key>', 'class', '', '', 1"], of2=["'CartController', 'class', '', '[Area(\"shop<size>\")]', 2", "'PlainController', 'class', '', '', 14"], of3=["'Program', 'top-level-statements', '', '', 1"]))
_facts("varied_members", VARIED_CODE, lambda c: c.methods, ["owner", "member AS name", "returns", PARAMETERS, "line"], varied(
    "NULL::BIGINT AS seq, '' AS owner, '' AS name, '' AS returns, '' AS parameters, 0 AS line",
    of0=["'Outer<key>', 'Sum', 'int', 'int[] xs,Clock clock', 13", "'Outer<key>', 'Nothing', 'void', '', 14", "'Outer<key>', 'Find', 'Task', 'string q,CancellationToken stop', 15", "'Outer<key>', 'Deep', 'void', 'IMailer m', 24", "'Inner', 'Deep', 'void', 'IMailer m', 24", "'IOuter', 'Sum', 'int', 'int[] xs,Clock clock', 26", "'IOuter', 'Reset', 'void', '', 26"],
    of1=["'Left<key>', 'Shown', 'void', '', 5"], of2=["'CartController', 'Change', 'void', 'int id', 5", "'CartController', 'Gone', 'void', '', 9", "'CartController', 'Own', 'void', '', 11", "'CartController', 'NotAdded', 'void', '', 12", "'PlainController', 'List', 'int', '', 14"]))
_facts("varied_calls", VARIED_CODE, Code.calls, ["owner", "source_method", "target", "type", "method", "line"], varied(
    "NULL::BIGINT AS seq, '' AS owner, '' AS source_method, '' AS target, '' AS type, '' AS method, 0 AS line",
    of0=["'Outer<key>', 'Sum', '_store', 'IStore<size>', 'Load', 13", "'Outer<key>', 'Sum', 'clock', 'Clock', 'Now', 13", "'Outer<key>', 'Find', 'cart', 'Cart<size>', 'Put', 20", "'Outer<key>', 'Find', 'repo', 'IRepository', 'Save', 22", "'Outer<key>', 'Deep', 'm', 'IMailer', 'Send', 24", "'Outer<key>', 'Deep', '_store', 'IStore<size>', 'Drop', 24", "'Inner', 'Deep', 'm', 'IMailer', 'Send', 24"],
    of1=["'Left<key>', 'Shown', 'Store', 'Store', 'Run<size>', 6"], of3=["'Program', NULL, 'WebApplication', 'WebApplication', 'Create', 1"]))
_facts("varied_dependencies", VARIED_CODE, Code.dependencies, ["owner", "source", "name", "type", "method"], varied(
    "NULL::BIGINT AS seq, '' AS owner, '' AS source, '' AS name, '' AS type, '' AS method",
    of0=["'Outer<key>', 'constructor', 'store', 'IStore<size>', NULL", "'Outer<key>', 'method_parameter', 'm', 'IMailer', 'Deep'", "'Inner', 'method_parameter', 'm', 'IMailer', 'Deep'"]))
_facts("varied_routes", VARIED_CODE, lambda c: c.attribute_routes().select("seq", "owner", "method", "route", "line").unionByName(c.mapped_routes().select("seq", "owner", "method", "route", "line")).unionByName(c.framework_routes().select("seq", "owner", "method", "route", "line")), ["owner", "method", "route", "line"], varied(
    "NULL::BIGINT AS seq, '' AS owner, '' AS method, '' AS route, 0 AS line",
    of2=["'CartController', 'GET', '/shop<size>', 5", "'CartController', 'POST', '/shop<size>/add/{id}', 5", "'CartController', 'DELETE', '/shop<size>/gone', 9", "'CartController', 'PUT', '/shop<size>/own<key>', 11", "'PlainController', 'GET', '/Plain/List', 14"],
    of3=["'Program', 'GET', '/api<size>/v1/again/x', 5", "'Program', 'POST', '/y<key>', 5", "'Program', 'DELETE', '/z', 5", "'Program', 'unknown', '/{a}/{b}', 6", "'Program', 'GET', '/ok', 7", "'Program', 'unknown', 'ASP.NET Razor Pages route registration', 8"]), keep=True)
_facts("varied_registrations", VARIED_CODE, Code.registrations, ["lifetime", "service", "implementation", "line"], varied(
    "NULL::BIGINT AS seq, '' AS lifetime, '' AS service, '' AS implementation, 0 AS line", of3=["'Scoped', 'IA', 'A', 2", "'HostedService', 'Worker<size>', 'Worker<size>', 2", "'Transient', 'IX', 'X<key>', 3"]))


REGISTRY_ORACLE = (
    "WITH r AS (" + expected("'GET' AS method, '/zone<size>/api/W<key>/items/{id}/<size>' AS path, 1 AS k", "'POST', '/zone<size>/api/W<key>/items', 2", "'DELETE', '/zone<size>/api/W<key>/gone/Drop', 3", "'PATCH', '/zone<size>/api/W<key>', 4",
                              "'GET', '/api<size>/v1/shop/deep/end/items', 5", "'PUT', '/api<size>/v1/shop/<key>', 6", "'POST', '/orders', 7", "'DELETE', '/x', 8", "'unknown', '/{controller}/<size>', 9", "'unknown', 'ASP.NET Razor Pages route registration', 10",
                              "'unknown', 'ASP.NET controller route registration', 11", "'unknown', 'MinimalApi.Endpoint route registration', 12", "'unknown', '/index.html', 13", "'GET', '/health<size>', 14") + ")"
    " SELECT 'component' AS section, seq, concat('W', cast(seq AS VARCHAR), 'Controller') AS name, 'Controller' AS type, 'API' AS detail FROM (SELECT p_partkey AS seq FROM part) p"
    " UNION ALL SELECT 'component', seq, concat('Spare', cast(seq AS VARCHAR)), 'Unknown', 'Unknown' FROM (SELECT p_partkey AS seq FROM part) p"
    " UNION ALL SELECT 'component', seq, 'Program', 'Configuration', 'CrossCutting' FROM (SELECT p_partkey AS seq FROM part) p"
    " UNION ALL SELECT 'route', seq, concat(method, ' ', path), CASE WHEN k = 13 THEN 'FrontendRoute' ELSE 'HTTP_API' END, CASE WHEN k <= 4 THEN concat('W', cast(seq AS VARCHAR), 'Controller') ELSE 'Program' END FROM r"
    " UNION ALL SELECT 'dependency', seq, d, 'calls', concat('W', cast(seq AS VARCHAR), 'Controller') FROM (SELECT p_partkey AS seq, unnest(['IOrderService', 'ICatalogService', 'Basket' || cast(p_size AS VARCHAR), 'Helper', 'IMediator', 'ICache']) AS d FROM part) x"
    " UNION ALL SELECT 'dependency', seq, 'IStore', 'calls', concat('Spare', cast(seq AS VARCHAR)) FROM (SELECT p_partkey AS seq FROM part) p"
    " UNION ALL SELECT 'dependency', seq, d, 'constructor', concat('W', cast(seq AS VARCHAR), 'Controller') FROM (SELECT p_partkey AS seq, unnest(['IOrderService', 'IMediator']) AS d FROM part) x"
    " UNION ALL SELECT 'dependency', seq, 'IStore', 'property_injection', concat('W', cast(seq AS VARCHAR), 'Controller') FROM (SELECT p_partkey AS seq FROM part) p"
    " UNION ALL SELECT 'dependency', seq, d, 'method_parameter', concat('W', cast(seq AS VARCHAR), 'Controller') FROM (SELECT p_partkey AS seq, unnest(['ICatalogService', 'IMediator']) AS d FROM part) x"
    " UNION ALL SELECT 'entry_point', seq, concat('/zone', cast(p_size AS VARCHAR), '/api/W', cast(seq AS VARCHAR)), 'controller', concat('W', cast(seq AS VARCHAR), 'Controller') FROM (SELECT p_partkey AS seq, p_size FROM part) p"
    " UNION ALL SELECT 'entry_point', seq, 'src/Api' || cast(seq AS VARCHAR) || '/Program.cs', 'bootstrap', 'Program' FROM (SELECT p_partkey AS seq FROM part) p"
)


@register("symbol_registry_rows", REGISTRY_ORACLE)
def symbol_registry_rows(spark, sf_dir):
    """Components with their class, routes, distinct dependencies and entry points, from one reading of all files.

    Entry points are start-up files, and controllers by the shortest of their routes."""
    code = Code(B.texts(spark, sf_dir, CONTROLLER_CODE).unionByName(B.texts(spark, sf_dir, STARTUP_CODE)), keep=True)
    section = lambda name, rows, *parts: rows.select(F.lit(name).alias("section"), "seq", *(c.alias(to) for c, to in zip(parts, ("name", "type", "detail"), strict=True)))
    col = F.col
    types = code.types.select("seq", col("owner").alias("name"), "kind", col("path").alias("file"), F.array_join("bases", ",").alias("bases"), F.array_join("attributes", ";").alias("annotations"), F.lit("").alias("dep_types"), F.lit("backend").alias("category"))
    components = section("component", C.classify_components(types), col("name"), col("component_type"), col("layer"))
    by_attribute = cut(code.attribute_routes())
    mapped, framework = code.mapped_routes(), code.framework_routes()
    said = F.concat_ws(" ", "method", "route")
    routes = section("route", by_attribute, said, F.lit("HTTP_API"), col("owner")).unionByName(section("route", mapped, said, F.lit("HTTP_API"), col("owner"))).unionByName(section("route", framework, said, col("type"), col("owner")))
    linked = section("dependency", code.calls(), col("type"), F.lit("calls"), col("owner")).unionByName(section("dependency", code.dependencies(), col("type"), col("source"), col("owner"))).distinct()
    shortest = by_attribute.groupBy("seq", "owner").agg(F.min(F.struct(F.length("route"), "route"))["route"].alias("route"))
    starts = code.types.where("owner = 'Program'")
    entries = section("entry_point", shortest, col("route"), F.lit("controller"), col("owner")).unionByName(section("entry_point", starts, col("path"), F.lit("bootstrap"), col("owner")))
    return components.unionByName(routes).unionByName(linked).unionByName(entries)


PYTHON = made("import os", "", "class A<key>(Base):", '    """About."""', "    def save<size>(self, x, y=1):", '        """Saves <key>."""', "        return x", "", "async def load(*names):", "    pass")
PYTHON_CODE = f"SELECT p_partkey AS seq, CASE WHEN p_size % 10 = 0 THEN 'def (' ELSE {PYTHON} END AS text FROM <<part>>"


@register("python_facts", "SELECT * FROM (" + expected("'class' AS kind, 'A<key>' AS name, 3 AS line, '' AS arguments, '' AS docstring, false AS is_async", "'method', 'save<size>', 5, 'self,x,y', 'Saves <key>.', false", "'method', 'load', 9, '', '', true") + ") t WHERE seq NOT IN (SELECT p_partkey FROM part WHERE p_size % 10 = 0)")
def python_facts(spark, sf_dir):
    return parsers.extract(B.texts(spark, sf_dir, PYTHON_CODE), "python_symbols", "seq").withColumn("arguments", F.array_join("arguments", ","))


@register("type_headers", expected("'class' AS kind, 'W<key>Controller' AS name, 'ControllerBase,IDisposable' AS bases, 5 AS start_line, 38 AS end_line, 'Find,Drop,Plain' AS methods", "'class', 'Spare<key>', '', 40, 44, ''"))
def type_headers(spark, sf_dir):
    types = Code(B.texts(spark, sf_dir, CONTROLLER_CODE)).headers()
    return types.select("seq", "kind", F.col("owner").alias("name"), F.array_join("bases", ",").alias("bases"), F.col("line").alias("start_line"), "end_line", F.array_join("members", ",").alias("methods"))


BRACES = made("{ a<key> \"}\" /* } */ '}' // }", "  { b } @\"q\"\"}\" } tail")


@register("brace_ends", f"SELECT p_partkey AS seq, length({BRACES}) - 6 AS closed_at FROM part")
def brace_ends(spark, sf_dir):
    return B.source(spark, sf_dir, f"SELECT p_partkey AS seq, {BRACES} AS text FROM <<part>>").select("seq", matching_brace(F.col("text")).alias("closed_at"))


@register("comma_parts", expected("0 AS place, 'Map<int, W<key>>' AS part", "1, 'f(a, b)'", "2, '[x, <size>]'", "3, 'plain'"))
def comma_parts(spark, sf_dir):
    rows = B.source(spark, sf_dir, f"SELECT p_partkey AS seq, {made('Map<int, W<key>>, f(a, b),[x, <size>], , plain')} AS text FROM <<part>>")
    return rows.select("seq", F.posexplode(split_commas(F.col("text"))).alias("place", "part"))


@register("parameter_rows", expected("0 AS place, 'Map<int, W<key>>' AS type, 'a' AS name", "1, 'int', 'b'", "2, 'IStore', 'store<size>'"))
def parameter_rows(spark, sf_dir):
    rows = B.source(spark, sf_dir, f"SELECT p_partkey AS seq, {made('[FromBody] Map<int, W<key>> a = null, ref int? b /* , no */, this IStore store<size> // end')} AS text FROM <<part>>")
    return rows.select("seq", F.posexplode(parameters(F.col("text"))).alias("place", "p")).select("seq", "place", "p.type", "p.name")


@register("text_reads", f"SELECT p_partkey AS seq, concat('a', {KEY}, chr(65533), 'é') AS replaced, concat('a', {KEY}, 'é') AS ignored FROM part")
def text_reads(spark, sf_dir):
    content = F.concat(F.concat(F.lit("a"), F.col("key")).cast("binary"), F.unhex(F.lit("FF")), F.lit("é").cast("binary"))
    rows = B.source(spark, sf_dir, f"SELECT p_partkey AS seq, {KEY} AS key FROM <<part>>")
    return rows.select("seq", S.text_of(content).alias("replaced"), S.text_of(content, replace=False).alias("ignored"))


def _files(name: str, text: str, more: str = "") -> str:
    return f"SELECT concat('d/', {KEY}, '/{name}') AS path, {text} AS text{more} FROM <<part>>"


XML_CONFIG = _files("web.config", made('<?xml version="1.0"?>', '<c><appSettings><add key="Size" value="<size>"/><add key="ApiKey" value="s"/></appSettings>', '<connectionStrings><add name="Main" connectionString="Server=h<key>"/></connectionStrings><skip key="x"/></c>'), ", 'xml' AS format")
YAML_CONFIG = _files("app.yml", made("server:", "  port: <size>", "  hosts:", "    - h<key>", "    - name: two", "empty:"), ", 'yaml' AS format")


@register("xml_params", f"SELECT concat('d/', {KEY}, '/web.config') AS path, unnest(['Size', 'ApiKey', 'Main']) AS key, unnest([{SIZE}, '***REDACTED***', concat('Server=h', {KEY})]) AS value FROM part")
def xml_params(spark, sf_dir):
    return S.parameters(B.texts(spark, sf_dir, XML_CONFIG)).select("path", "key", "value")


@register("yaml_params", f"SELECT concat('d/', {KEY}, '/app.yml') AS path, unnest(['server.port', 'server.hosts[0]', 'server.hosts[1].name', 'empty']) AS key, unnest([{SIZE}, concat('h', {KEY}), 'two', '']) AS value FROM part")
def yaml_params(spark, sf_dir):
    return S.parameters(B.texts(spark, sf_dir, YAML_CONFIG)).select("path", "key", "value")


PROJECT = _files("A.csproj", made('<Project xmlns="urn:x" Sdk="Microsoft.NET.Sdk.Web"><PropertyGroup><TargetFrameworks>net8.0;net<size>.0</TargetFrameworks><OutputType>Exe</OutputType></PropertyGroup>', '<ItemGroup><PackageReference Include="P<size>" /><PackageReference Include="A" /><ProjectReference Include="..\\B\\B<key>.csproj" /></ItemGroup></Project>'))


@register("csproj_rows", f"SELECT concat('d/', {KEY}, '/A.csproj') AS path, 'Microsoft.NET.Sdk.Web' AS sdk, concat('net8.0,net', {SIZE}, '.0') AS frameworks, concat('A,P', {SIZE}) AS packages, concat('../B/B', {KEY}, '.csproj') AS project_references, 'Exe' AS output_type FROM part")
def csproj_rows(spark, sf_dir):
    listed = lambda c: F.array_join(c, ",").alias(c)
    return S.project_files(B.texts(spark, sf_dir, PROJECT)).select("path", "sdk", listed("frameworks"), listed("packages"), listed("project_references"), "output_type")


NODE = _files("package.json", f"CASE p_size % 4 WHEN 0 THEN {made('{\"dependencies\": {\"vue\": \"1\", \"x<key>\": \"2\"}, \"devDependencies\": {\"vite\": \"3\"}}')} WHEN 1 THEN '{{}}' WHEN 2 THEN '{{\"devDependencies\": {{\"react\": \"1\", \"@angular/core\": \"1\"}}}}' ELSE '{{' END")


@register("package_rows", f"""SELECT concat('d/', {KEY}, '/package.json') AS path, CASE p_size % 4 WHEN 0 THEN 'Vue' WHEN 2 THEN 'React' ELSE 'unknown' END AS framework, CASE p_size % 4 WHEN 0 THEN concat('vite,vue,x', {KEY}) WHEN 2 THEN '@angular/core,react' ELSE '' END AS packages,
  CASE p_size % 4 WHEN 3 THEN 0.2 WHEN 1 THEN 0.75 ELSE 0.9 END::DOUBLE AS confidence FROM part""")
def package_rows(spark, sf_dir):
    return S.packages(B.texts(spark, sf_dir, NODE)).withColumn("packages", F.array_join("packages", ","))


SOLUTION = _files("App.sln", made('Project("{9A19}") = "Web<size>", "src\\Web\\Web<key>.csproj", "{1}"', "EndProject", 'Project("{2}")="Core",  "Core.csproj", "{3}"'))


@register("solution_rows", f"SELECT concat('d/', {KEY}, '/App.sln') AS path, unnest([concat('Web', {SIZE}), 'Core']) AS name, unnest([concat('src/Web/Web', {KEY}, '.csproj'), 'Core.csproj']) AS project FROM part")
def solution_rows(spark, sf_dir):
    return S.solution_projects(B.texts(spark, sf_dir, SOLUTION))


@register("phase_tables", "SELECT 'inventory' AS phase, count(*) AS n, count(DISTINCT p_brand) AS kinds FROM part UNION ALL SELECT 'parsed', count(*), count(DISTINCT s_nationkey) FROM supplier")
def phase_tables(spark, sf_dir):
    """Phase tables written and read back from the shared folder."""
    from lodestrata.sources.shared import folder

    at = folder(spark, "phases")
    S.write_phase({"inventory": B.source(spark, sf_dir, "SELECT p_partkey, p_brand AS kind FROM <<part>>"), "parsed": B.source(spark, sf_dir, "SELECT s_suppkey, s_nationkey AS kind FROM <<supplier>>")}, at)
    read = lambda name: spark.read.parquet(f"{at}/{name}").agg(F.count("*").alias("n"), F.count_distinct("kind").alias("kinds")).select(F.lit(name).alias("phase"), "n", "kinds")
    return read("inventory").unionByName(read("parsed"))


#: Files in marked answers with their place: the first names a row's own file, the second one that rows of a size share.
SAVED = f"""WITH m AS (SELECT seq, unnest(regexp_extract_all(text, {q(X.MARKER)}, 1)) AS marked, unnest(regexp_extract_all(text, {q(X.MARKER)}, 2)) AS body FROM ({B.duck(B.MARKED)}) t), n AS (SELECT seq, concat('answers/', regexp_replace(marked, '^.*/', '')) AS name, trim(body, chr(10)) AS body FROM m),
  p AS (SELECT concat('phases/inventory/', p_brand, '.json') AS name, concat('{{"brand":"', p_brand, '","parts":', count(*), ',"largest":', max(p_size), '}}') AS body FROM part GROUP BY p_brand)
  SELECT name, strlen(any_value(body))::BIGINT AS n_bytes, sha256(arg_max(body, seq)) AS sha256 FROM n GROUP BY name HAVING strlen(arg_max(body, seq)) > 0 UNION ALL SELECT name, strlen(body)::BIGINT, sha256(body) FROM p"""


@register("saved_files", SAVED)
def saved_files(spark, sf_dir):
    """Marked answers and phase artifacts put down as files by name, and read back from the folder."""
    from lodestrata.sources.shared import folder

    marked = X.matches(B.texts(spark, sf_dir, B.MARKED), X.MARKER, [1, 2], "seq").select(
        "seq", "pos", F.concat(F.lit("answers/"), F.substring_index("g1", "/", -1)).alias("name"), F.trim(F.col("g2"), F.lit("\n")).alias("content"))
    brands = B.source(spark, sf_dir, "SELECT p_brand AS brand, count(*) AS parts, max(p_size) AS largest FROM <<part>> GROUP BY p_brand")
    phases = brands.select(F.concat(F.lit("phases/inventory/"), "brand", F.lit(".json")).alias("name"), F.to_json(F.struct("brand", "parts", "largest")).alias("content"))
    at = folder(spark, "saved")
    N.save(N.last_of_each(marked, "seq", "pos").unionByName(phases), at)
    found = N.contents(marked.select("name").distinct().unionByName(phases.select("name")), at)
    return found.where("length(content) > 0").select("name", F.length("content").cast("long").alias("n_bytes"), F.sha2("content", 256).alias("sha256"))


CONTRACTS = [
    ("part", ["p_partkey", "p_brand"], ["p_partkey"], []), ("part", ["p_partkey", "owner"], [], []), ("region", ["r_regionkey"], ["r_regionkey"], []), ("orders", ["o_x", "o_y"], [], []),
    ("events", ["event_id", "props"], ["event_id"], ["props", "event_type"]), ("documents", ["doc_id"], ["doc_id", "source"], []),
]


@register("contract_rows", """SELECT 1 AS number, 'part: column owner is missing' AS problem UNION ALL SELECT 3, 'orders: column o_x is missing' UNION ALL SELECT 3, 'orders: column o_y is missing' UNION ALL SELECT 6, 'none: no rows'
  UNION ALL SELECT 4, concat('events: ', count(*), ' rows of event_type are no JSON') FROM events WHERE event_type IS NOT NULL AND NOT json_valid(event_type) HAVING count(*) > 0
  UNION ALL SELECT 4, concat('events: ', count(*), ' rows of props are no JSON') FROM events WHERE props IS NOT NULL AND NOT json_valid(props) HAVING count(*) > 0
  UNION ALL SELECT 4, concat('events: ', count(*), ' rows without event_id') FROM events WHERE event_id IS NULL HAVING count(*) > 0
  UNION ALL SELECT 5, concat('documents: ', count(*), ' rows without source') FROM documents WHERE source IS NULL HAVING count(*) > 0
  UNION ALL SELECT 5, concat('documents: ', count(*), ' rows without doc_id') FROM documents WHERE doc_id IS NULL HAVING count(*) > 0""")
def contract_rows(spark, sf_dir):
    tables = [S.Contract(name, B.source(spark, sf_dir, f"SELECT * FROM <<{name}>>"), needed, keys, json) for name, needed, keys, json in CONTRACTS]
    return S.contract_problems([*tables, S.Contract("none", spark.range(0), ["id"])])


STEPS = "SELECT concat('step', cast(o_custkey % 7 as varchar(20))) AS label, CASE WHEN o_orderkey % 5 = 0 THEN 1 WHEN o_orderkey % 11 = 0 THEN NULL ELSE 0 END AS returncode, cast(o_orderkey % 8 as double) / 4 AS duration FROM <<orders>>"


@register("runtime_evidence", f"SELECT label, count(*) AS runs, count(*) FILTER (WHERE returncode = 0) AS ok, count(*) - count(*) FILTER (WHERE returncode = 0) AS failed, round(sum(duration), 3) AS seconds, '2024-01-01T00:00:00Z' AS extraction_timestamp FROM ({B.duck(STEPS)}) t GROUP BY label")
def runtime_evidence(spark, sf_dir):
    return A.tag_run(A.step_summary(B.source(spark, sf_dir, STEPS)), "2024-01-01T00:00:00Z")
