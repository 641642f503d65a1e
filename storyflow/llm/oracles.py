"""Oracle SQL of the text operators that SQL can express: stretches of captions
that tell the same thing, and repetition inside a text.

The SQL goes another way than the operators: no shards, no boundary rows, no
rewriting from the end; the patterns have no look-behind and no back reference.
"""

from __future__ import annotations

from . import runs

_H = "㐀-鿿"
_EDGE = "' '||chr(9)||chr(10)||chr(13)||chr(160)||chr(12288)||chr(65279)||'[](){}【】「」（）'"


def _ms(column: str) -> str:
    """Milliseconds of a readable time, else null."""
    t = f"trim({column},{_EDGE})"
    p = f"string_split_regex({t},'[:.]')"
    ms = f"CAST(({p})[1] AS BIGINT)*3600000+CAST(({p})[2] AS BIGINT)*60000+CAST(({p})[3] AS BIGINT)*1000+COALESCE(CAST(rpad(({p})[4],3,'0') AS BIGINT),0)"
    return f"CASE WHEN regexp_full_match({t},'[0-9]{{2,}}:[0-5][0-9]:[0-5][0-9](\\.[0-9]{{1,3}})?') THEN {ms} END"


def _words(phrases: tuple[str, ...], han: bool) -> str:
    return "|".join(sorted((p for p in phrases if ("一" <= p[-1] <= "鿿") == han), key=len, reverse=True))


def _letters(text: str) -> str:
    """The letters of a text in order, of neighbouring equal ones only the first."""
    cs = f"string_split({text},'')"
    return f"array_to_string(list_sort(list_filter({cs},lambda c,i: i=1 OR c<>({cs})[i-1])),'')"


def _link(n: int) -> str:
    """Whether a key starts with a misspelt linking phrase of ``n`` words."""
    links = [p for p in runs._LONG_LINKS if p.count(" ") + 1 == n]
    head = f"array_to_string(string_split(b1,' ')[1:{n}],' ')"
    known = ",".join(f"{_letters(f"'{p}'")}" for p in links)
    first = ",".join(sorted({f"'{c}'" for p in links for c in p[:2]}))
    sizes = f"len({head})>={min(map(len, links)) - 1} AND len({head})<={max(map(len, links)) + 2} AND len({head})<len(b1)"
    return f"WHEN b1[1:1] IN ({first}) AND {sizes} AND {_letters(head)} IN ({known}) THEN substr(b1,len({head})+2)"


_COUNT = "(len({0})-len(replace({0},c,'')))"
_X, _Y = _COUNT.format("p.x"), _COUNT.format("p.y")
_TWICE = "(contains({0},c||c) OR (greatest(len(p.x),len(p.y))>=6 AND abs(len(p.x)-len(p.y))<=1 AND regexp_matches({0},c||'.'||c)))"
_FITS = f"({_X}={_Y} OR ({_X}>{_Y} AND {_Y}>0 AND {_TWICE.format('p.x')}) OR ({_Y}>{_X} AND {_X}>0 AND {_TWICE.format('p.y')}))"
_START = "(p.x[1:1]=p.y[1:1] OR (p.x[1:1]=p.y[2:2] AND p.x[2:2]=p.y[1:1]))"
_SLIP = f"(p.x=p.y OR ({_START} AND levenshtein(p.x,p.y)<=6 AND len(list_filter(list_distinct(string_split(p.x||p.y,'')),lambda c: NOT {_FITS}))=0))"
_PAIRS = "list_transform(range(1,len(wa)+1),lambda i: struct_pack(x:=wa[i],y:=wb[i]))"

P1_FOUND = (
    f"WITH ev AS (SELECT DISTINCT run_id,chunk_i,ev_i,{_ms('start_time')} AS a,greatest({_ms('start_time')},{_ms('end_time')}) AS late,step3_synthesized_dense_caption AS cap FROM pass1_progress),"
    "e0 AS (SELECT *,regexp_replace(replace(lower(cap),'ß','ss'),'[^\\p{L}\\p{N}]+',' ','g') AS k0 FROM ev WHERE a IS NOT NULL),"
    f"e1 AS (SELECT *,replace(regexp_replace(regexp_replace(k0,'([{_H}]) ([{_H}])','\\1\\2','g'),'([{_H}]) ([{_H}])','\\1\\2','g'),'的','') AS k1 FROM e0),"
    f"e2 AS (SELECT *,trim(regexp_replace(regexp_replace(k1,'([{_H}])([^{_H} ])','\\1 \\2','g'),'([^{_H} ])([{_H}])','\\1 \\2','g'),' ') AS k FROM e1),"
    "e3 AS (SELECT * EXCLUDE (k),CASE WHEN cap IS NULL OR (k='' AND regexp_full_match(cap,'[\\s\\p{Z}\\p{C}]*')) THEN NULL WHEN k='' THEN trim(cap,' ') ELSE k END AS k FROM e2),"
    f"e4 AS (SELECT *,regexp_replace(k,'^(?:(?:{_words(runs.LINKING, False)})(?: |$)|(?:{_words(runs.LINKING, True)}) ?)+','') AS b1 FROM e3),"
    f"e5 AS (SELECT *,CASE {_link(2)} {_link(1)} ELSE b1 END AS b2 FROM e4),"
    f"e6 AS (SELECT *,trim(regexp_replace(b2,'(?:(?:^| )(?:{_words(runs.GOES_ON, False)})| ?(?:{_words(runs.GOES_ON, True)}))+$',''),' ') AS b3 FROM e5),"
    "q AS (SELECT run_id,chunk_i,ev_i,a,late,CASE WHEN b3='' THEN k ELSE b3 END AS k FROM e6),"
    "n AS (SELECT *,lag(k) OVER (PARTITION BY run_id ORDER BY a,chunk_i,ev_i) AS pk FROM q),"
    "w AS (SELECT *,string_split(k,' ') AS wa,string_split(pk,' ') AS wb FROM n),"
    f"s AS (SELECT *,COALESCE(k=pk OR (len(wa)=len(wb) AND len(list_filter({_PAIRS},lambda p: NOT {_SLIP}))=0),false) AS same FROM w),"
    "g AS (SELECT *,sum(CASE WHEN same THEN 0 ELSE 1 END) OVER (PARTITION BY run_id ORDER BY a,chunk_i,ev_i ROWS UNBOUNDED PRECEDING) AS isl FROM s WHERE true)"
    "SELECT run_id,arg_min(chunk_i,(a,chunk_i,ev_i)) AS chunk_i,arg_min(ev_i,(a,chunk_i,ev_i)) AS ev_i,CAST(count(*) AS INT) AS n_events,CAST(max(late)-min(a) AS BIGINT) AS duration_ms"
    " FROM g GROUP BY run_id,isl HAVING count(*)>1"
)

_SPACE = "[\\s\\p{Z}]"
_MARKED = (
    f"regexp_replace(regexp_replace(regexp_replace(replace(lower(t),'ß','ss'),'([.!?…])[\"''”’»)\\]]*{_SPACE}+','\\1'||chr(30),'g'),"
    f"'([。！？])[\"”’」』）)]*{_SPACE}*','\\1'||chr(30),'g'),'\\n+',chr(30),'g')"
)
_TOKENS = f"list_filter(regexp_extract_all(regexp_replace(s,'([{_H}぀-ヿ])',' \\1 ','g'),'[{_H}぀-ヿ]|[\\p{{L}}\\p{{N}}]+'),lambda w: NOT regexp_full_match(w,'[0-9]+'))"
_NEXT = lambda n: "||' '||".join(["w"] + [f"lead(w,{i}) OVER o" for i in range(1, n)])

P6_FOUND = (
    "WITH tx AS (SELECT DISTINCT 'step1_objective_visual' AS field,run_id,chunk_i::VARCHAR||':'||ev_i::VARCHAR AS item_id,step1_objective_visual AS t FROM pass1_progress"
    " UNION SELECT 'frame_caption',run_id,event_id,frame_caption FROM stage2_refined"
    " UNION SELECT 'final_caption',run_id,e.event_id,e.final_caption FROM (SELECT run_id,unnest(c.events) AS e FROM (SELECT run_id,unnest(chapters) AS c FROM stage3_polished)) WHERE e IS NOT NULL),"
    f"se AS (SELECT field,run_id,item_id,unnest(string_split({_MARKED},chr(30))) AS s,generate_subscripts(string_split({_MARKED},chr(30)),1) AS i FROM tx WHERE t IS NOT NULL),"
    f"tk AS (SELECT field,run_id,item_id,i,{_TOKENS} AS ws FROM se),"
    "wd AS (SELECT field,run_id,item_id,i,array_to_string(ws,' ') AS own,len(ws) AS n,unnest(ws) AS w,generate_subscripts(ws,1) AS k FROM tk),"
    "m AS (SELECT *,CASE WHEN 2*sum(CASE WHEN len(w)=1 AND ord(w)>13311 THEN 1 ELSE 0 END) OVER d>count(*) OVER d THEN 5 ELSE 4 END AS m FROM wd WINDOW d AS (PARTITION BY field,run_id,item_id)),"
    f"gr AS (SELECT *,CASE WHEN m=5 THEN {_NEXT(5)} ELSE {_NEXT(4)} END AS g,COALESCE(lag(w) OVER o=w,false) AS twice FROM m WINDOW o AS (PARTITION BY field,run_id,item_id ORDER BY i,k)),"
    "rp AS (SELECT *,CASE WHEN g IS NOT NULL AND row_number() OVER (PARTITION BY field,run_id,item_id,g ORDER BY i,k)>1 THEN 1 ELSE 0 END AS r,"
    "n>=2 AND n<m AND dense_rank() OVER (PARTITION BY field,run_id,item_id,own ORDER BY i)>1 AS said FROM gr),"
    "cv AS (SELECT *,twice OR said OR CASE WHEN m=5 THEN max(r) OVER (o ROWS 4 PRECEDING) ELSE max(r) OVER (o ROWS 3 PRECEDING) END=1 AS c FROM rp WINDOW o AS (PARTITION BY field,run_id,item_id ORDER BY i,k))"
    "SELECT field,run_id,item_id FROM cv GROUP BY 1,2,3 HAVING count(*)>1 AND 10*sum(CASE WHEN c THEN len(w) ELSE 0 END)>=3*sum(len(w))"
)

SQL = {"p1_found": P1_FOUND, "p6_found": P6_FOUND}
