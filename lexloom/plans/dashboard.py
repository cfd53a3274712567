"""A self-contained HTML page of a report: analytics from DataFrames, rows as JSON, and a small script that
filters, sorts, counts and pages them in the browser."""

from __future__ import annotations

import html
import json

from pyspark.sql import DataFrame

from ..operators.reports import BOOLEANS, page_sizes, report_histograms, report_totals
from ..sources import files

COLUMNS = ("token", "token_lower", "game", "language", "origin_class", "filter_status", "filter_match_type", "tb_key", "tb_source_entity", "lineage_tags", "source_base_words", "assigned_flags", "source_games", *BOOLEANS)
MOST_ROWS = 200_000


def analytics(rows: DataFrame) -> dict:
    """Totals, booleans and histograms of a report."""
    total = report_totals(rows).first().asDict()
    out = {"totals": {k: v for k, v in total.items() if k not in BOOLEANS}, "booleans": {k: total[k] for k in BOOLEANS}}
    for r in report_histograms(rows).orderBy("metric", "rows", ascending=[True, False]).collect():
        out.setdefault(r["metric"], {})[r["value"]] = r["rows"]
    return out


def write_dashboard(rows: DataFrame, path: str, title: str = "Token provenance", source: str = "") -> dict:
    """Write the page. A page is for people, so it takes at most MOST_ROWS rows; larger reports are refused
    and want a filter first (report_query())."""
    n = rows.count()
    if n > MOST_ROWS:
        raise ValueError(f"{n} rows are too many for one page; filter the report first")
    shown = [r.asDict(recursive=True) for r in rows.select(*[c for c in COLUMNS if c in rows.columns]).orderBy("token_lower").collect()]
    payload = json.dumps({"rows": shown, "analytics": analytics(rows), "sizes": page_sizes(), "source": source}, ensure_ascii=False).replace("</", "<\\/")
    page = _PAGE.replace("@TITLE@", html.escape(title)).replace("@DATA@", payload)
    files.write_bytes(rows.sparkSession, path, page.encode())
    return {"path": path, "rows": n}


_PAGE = """<!doctype html>
<meta charset="utf-8"><title>@TITLE@</title>
<style>
body{font:14px system-ui;margin:1.5rem;color:#222}h1{font-size:1.3rem}table{border-collapse:collapse;width:100%}
td,th{border-bottom:1px solid #ddd;padding:.25rem .5rem;text-align:left}th{cursor:pointer}.bar{background:#69c;height:.7rem}
#controls>*{margin:.2rem}#facts span{margin-right:1.2rem}
</style>
<h1>@TITLE@</h1><div id="facts"></div><div id="controls"></div><div id="bars"></div><table><thead></thead><tbody></tbody></table><div id="pager"></div>
<script>
const data=@DATA@, flags=["is_corpus_form","is_ghost_form","is_casing_inferred","in_tb_tokens"], picks=["origin_class","filter_status","filter_match_type","source_games"];
const heads=data.rows.length?Object.keys(data.rows[0]):[], el=(t,p={})=>Object.assign(document.createElement(t),p), list=v=>Array.isArray(v)?v:[v??""];
let view=data.rows, key=null, up=true, page=1, size=data.sizes[1];
const box=document.querySelector("#controls"), text=box.appendChild(el("input",{placeholder:"search"})), chosen={}, ticked={};
for(const c of picks.filter(c=>heads.includes(c))){const s=chosen[c]=box.appendChild(el("select"));s.append(el("option",{value:"",text:c}),el("option",{value:"__EMPTY__",text:"(empty)"}));
 [...new Set(data.rows.flatMap(r=>list(r[c])))].filter(Boolean).sort().forEach(v=>s.append(el("option",{value:v,text:v})))}
for(const c of flags.filter(c=>heads.includes(c))){const l=box.appendChild(el("label"));ticked[c]=l.appendChild(el("input",{type:"checkbox"}));l.append(c)}
const sizes=box.appendChild(el("select"));data.sizes.forEach(n=>sizes.append(el("option",{value:n,text:n||"all"})));sizes.value=size;
const fits=r=>Object.entries(chosen).every(([c,s])=>!s.value||(s.value==="__EMPTY__"?!list(r[c]).some(Boolean):list(r[c]).includes(s.value)))
 &&Object.entries(ticked).every(([c,t])=>!t.checked||r[c])&&(!text.value.trim()||heads.map(h=>list(r[h]).join(" ")).join(" ").toLowerCase().includes(text.value.trim().toLowerCase()));
const order=new Intl.Collator(undefined,{numeric:true,sensitivity:"base"});
function refresh(){view=data.rows.filter(fits);if(key)view.sort((a,b)=>{const x=list(a[key]).join(" | "),y=list(b[key]).join(" | ");return !x!==!y?(x?-1:1):(up?1:-1)*order.compare(x,y)});draw()}
function draw(){const n=size||view.length||1,last=Math.max(1,Math.ceil(view.length/n));page=Math.min(page,last);
 document.querySelector("thead").replaceChildren(el("tr"));heads.forEach(h=>document.querySelector("thead tr").append(el("th",{textContent:h,onclick(){up=key===h?!up:true;key=h;page=1;refresh()}})));
 document.querySelector("tbody").replaceChildren(...view.slice((page-1)*n,page*n).map(r=>{const t=el("tr");heads.forEach(h=>t.append(el("td",{textContent:list(r[h]).join(" | ")})));return t}));
 document.querySelector("#facts").replaceChildren(...[["rows",view.length],["distinct",new Set(view.map(r=>r.token_lower)).size],...flags.map(f=>[f,view.filter(r=>r[f]).length])].map(([k,v])=>el("span",{textContent:k+": "+v})));
 const counts={};view.forEach(r=>list(r.lineage_tags).forEach(t=>counts[t]=(counts[t]||0)+1));const top=Object.entries(counts).sort((a,b)=>b[1]-a[1]).slice(0,12);
 document.querySelector("#bars").replaceChildren(...top.map(([k,v])=>{const d=el("div",{textContent:k+" "+v});d.append(el("div",{className:"bar",style:"width:"+Math.max(2,v/top[0][1]*100)+"%"}));return d}));
 const p=document.querySelector("#pager");p.replaceChildren(el("button",{textContent:"<",onclick(){page=Math.max(1,page-1);draw()}}),` ${page} / ${last} `,el("button",{textContent:">",onclick(){page=Math.min(last,page+1);draw()}}))}
box.addEventListener("input",()=>{size=+sizes.value;page=1;refresh()});refresh();
</script>
"""
