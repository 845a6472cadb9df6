"""Pages of results for people: tables in HTML with a caption, points for a map."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from limnos.sources.files import at

STYLE = "<style>table{border-collapse:collapse;font:12px sans-serif}th,td{border:1px solid #ccc;padding:2px 6px;white-space:nowrap}th{cursor:pointer;position:sticky;top:0;background:#eee}</style>"
#: Sorting by a click on a header, a filter for each column and pages of some rows, all in the reader's browser.
SCRIPT = """<script>
const table=document.querySelector("table"),body=table.tBodies[0],rows=[...body.rows],boxes=[...table.querySelectorAll("input")],size=document.querySelector("select");
let page=0,order=null;
function show(){let r=rows.filter(x=>boxes.every((b,i)=>x.cells[i].textContent.toLowerCase().includes(b.value.toLowerCase())));
if(order!==null){const[i,d]=order;r.sort((a,b)=>d*a.cells[i].textContent.localeCompare(b.cells[i].textContent,undefined,{numeric:true}));}
const n=+size.value||r.length;page=Math.max(0,Math.min(page,Math.ceil(r.length/n)-1));body.replaceChildren(...r.slice(page*n,page*n+n));}
boxes.forEach(b=>b.oninput=()=>{page=0;show();});size.onchange=show;
[...table.tHead.rows[0].cells].forEach((c,i)=>c.onclick=()=>{order=[i,order&&order[0]===i?-order[1]:1];show();});
document.querySelectorAll("button").forEach((b,i)=>b.onclick=()=>{page+=i?1:-1;show();});show();
</script>"""
SIZES = (5, 10, 25, 50)


def escaped(value: Column) -> Column:
    """Text that HTML shows as it is; empty for null."""
    out = F.coalesce(value.cast("string"), F.lit(""))
    for sign, name in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;")):
        out = F.replace(out, F.lit(sign), F.lit(name))
    return out


def html_rows(df: DataFrame, name: str = "html") -> DataFrame:
    """A table row in HTML for each row."""
    cells = [F.concat(F.lit("<td>"), escaped(F.col(f"`{c}`")), F.lit("</td>")) for c in df.columns]
    return df.select(F.concat(F.lit("<tr>"), *cells, F.lit("</tr>")).alias(name))


def caption(text: Column, label: str | None = None, tip: str | None = None) -> Column:
    """A table's caption: an optional label before the text and a tip in bold behind it."""
    return F.concat(F.lit("<caption>"), F.lit(f"({label}) " if label else ""), escaped(text), F.lit(f" <b>{tip}</b>" if tip else ""), F.lit("</caption>"))


def html_page(df: DataFrame, path: str, title: str = "", tip: str | None = None, most: int = 10_000) -> str:
    """A page with all rows as a table that can be sorted, filtered and paged; more than `most` rows are an error, as they are for people."""
    lines = [r["html"] for r in html_rows(df).limit(most + 1).collect()]
    if len(lines) > most:
        raise ValueError(f"more than {most} rows for a page")
    head, boxes = (f"<tr>{''.join(f'<th>{x}</th>' for x in xs)}</tr>" for xs in (df.columns, ["<input>"] * len(df.columns)))
    spark = df.sparkSession
    above = spark.range(1).select(caption(F.lit(title), tip=tip).alias("c")).first()["c"]
    sizes = "".join(f"<option value={n}>{n or 'all'}</option>" for n in (*SIZES, 0))
    text = "\n".join(["<!doctype html><meta charset=utf-8>", STYLE, f"<select>{sizes}</select><button>&lt;</button><button>&gt;</button>", f"<table>{above}<thead>{head}{boxes}</thead><tbody>", *lines, "</tbody></table>", SCRIPT, ""])
    fs, where = at(spark, path)
    out = fs.create(where, True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
    return path


def features(df: DataFrame, lon: str, lat: str, properties: list[str], name: str = "feature") -> DataFrame:
    """A GeoJSON feature for each row with a place; a map reads one of each line."""
    x, y = F.col(f"`{lon}`").cast("double"), F.col(f"`{lat}`").cast("double")
    place = F.struct(F.lit("Point").alias("type"), F.array(x, y).alias("coordinates"))
    whole = F.struct(F.lit("Feature").alias("type"), place.alias("geometry"), F.struct(*[F.col(f"`{p}`") for p in properties]).alias("properties"))
    return df.filter(x.isNotNull() & y.isNotNull()).select(F.to_json(whole, {"ignoreNullFields": "false"}).alias(name))
