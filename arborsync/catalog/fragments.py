"""SQL fragments shared by the oracle queries (DuckDB dialect)."""

from __future__ import annotations

FILES = """files as (
  select doc_id, source, source || '-' || lang as section, text,
         source || '/' || lang || '/doc_' || cast(doc_id as varchar)
           || case doc_id % 6 when 0 then '.md' when 1 then '.TXT' when 2 then '.py'
                              when 3 then '.json' when 4 then '.tar.gz' else '' end as path
  from documents)"""

SNAPSHOTS = (
    FILES
    + """,
old_docs as (select * from files where doc_id % 10 <> 0),
new_docs as (
  select doc_id, source, section,
         case when doc_id % 10 = 2 then text || ' v2' else text end as text,
         case when doc_id % 10 = 3 then 'moved/' || path else path end as path
  from files where doc_id % 10 <> 1),
old_tree as (select *, sha256(text) as blob, octet_length(encode(text)) as size from old_docs),
new_tree as (select *, sha256(text) as blob, octet_length(encode(text)) as size from new_docs)"""
)


def changes(repo: str = "'corpus'") -> str:
    """A CTE ``changes(repo_id, status, old_path, new_path)`` on top of SNAPSHOTS."""
    return f"""{SNAPSHOTS},
o as (select {repo} as repo_id, path, blob from old_tree),
n as (select {repo} as repo_id, path, blob from new_tree),
j as (select coalesce(o.repo_id, n.repo_id) as repo_id, o.path as op, n.path as np, o.blob as ob, n.blob as nb
      from o full outer join n on o.repo_id = n.repo_id and o.path = n.path),
a as (select repo_id, np as path, nb as blob,
             row_number() over (partition by repo_id, nb order by np) as k from j where op is null),
d as (select repo_id, op as path, ob as blob,
             row_number() over (partition by repo_id, ob order by op) as k from j where np is null),
changes as (
  select coalesce(a.repo_id, d.repo_id) as repo_id,
         case when d.path is null then 'A' when a.path is null then 'D' else 'R' end as status,
         d.path as old_path, a.path as new_path
  from a full outer join d on a.repo_id = d.repo_id and a.blob = d.blob and a.k = d.k
  union all
  select repo_id, 'M', op, np from j where op is not null and np is not null and ob <> nb)"""


# The planted repository: what a content is made of (its identity), how long it
# is, and what reading it must give.
PLANTED = (
    FILES
    + """,
versions as (
  select 'old' as version, doc_id, source, text, path from files where doc_id // 20 % 10 <> 0
  union all
  select 'new', doc_id, source,
         case when doc_id // 20 % 10 = 2 then text || ' v2' else text end,
         case when doc_id // 20 % 10 = 3 then 'moved/' || path else path end
  from files where doc_id // 20 % 10 <> 1),
planted as (
  select *, octet_length(encode(text)) as text_bytes,
         case when doc_id % 9 in (4, 5) then 'unread:' || cast(doc_id as varchar)
              when doc_id % 9 >= 7 then 'plain:' || text
              else cast(doc_id % 9 as varchar) || ':' || text end as ident,
         doc_id % 11 = 4 as is_link
  from versions),
judged as (
  select *,
         case doc_id % 9
           when 0 then text_bytes + 8 when 1 then text_bytes + 1
           when 2 then greatest(text_bytes, 8192) + 5 when 3 then text_bytes + 1
           when 4 then 0 when 5 then 0 when 6 then text_bytes + 2 else text_bytes end as size,
         case when doc_id % 9 = 4 then 'not_found' when doc_id % 9 = 5 then 'read_error'
              when doc_id % 9 in (0, 1, 2, 6) or starts_with(text, 'MZ') or starts_with(text, 'GIF8')
                   or starts_with(text, '%PDF') then 'binary'
              when doc_id % 9 = 3 then 'non_utf8'
              else 'ok' end as outcome,
         case when doc_id % 9 in (0, 1, 6) or starts_with(text, 'MZ') or starts_with(text, 'GIF8')
                   or starts_with(text, '%PDF') then 'binary' else 'text' end as late_nul_is_text,
         case doc_id % 9 when 1 then text_bytes + 1 when 2 then greatest(text_bytes, 8192) + 5
           when 6 then text_bytes + 2 else text_bytes end as planted_bytes,
         case when doc_id % 9 = 2
              then text || repeat(' ', greatest(0, 8192 - text_bytes)) || chr(0) || 'tail'
              else text end as content
  from planted)"""
)

# Sources of the crawl: settings, key, filter and stored state per document source.
CRAWL_SOURCES = """numbered as (
  select distinct source as repo_id, cast(regexp_extract(source, '([0-9]+)$', 1) as integer) as n
  from documents),
settings as (
  select repo_id, n, 'https://git.example.com/corpus/' || repo_id || '.git' as repo_url,
         case n % 3 when 0 then 'main' when 1 then 'main' else 'dev' end as branch,
         case n % 5 when 0 then '' when 1 then repo_id || '/en' when 2 then '/' when 3 then 'moved/'
                    else '/' || repo_id || '/' end as subdir,
         case n % 3 when 0 then '' when 1 then '.md,txt,.PY' else ' .json , md ' end as extensions,
         case n % 3 when 0 then '' when 1 then '.md,.py,txt' else '.json,md' end as canonical,
         case n % 3 when 0 then '' when 1 then '\\.(md|txt|py)$' else '\\.(json|md)$' end as ext_regex
  from numbered),
sources as (
  select *, sha256(repo_url || ':' || branch || ':' || subdir || ':' || canonical)[1:16] as config_hash,
         case when trim(subdir, '/') = '' then '' else trim(subdir, '/') || '/' end as prefix,
         sha1(repo_id || ':new') as head_sha,
         case n % 4 when 0 then 'full' when 3 then 'full' when 2 then 'incremental'
                    else case when n % 8 = 1 then 'incremental' else 'noop' end end as mode0
  from settings)"""

CRAWL = (
    PLANTED
    + ",\n"
    + CRAWL_SOURCES
    + """,
eligible as (select * from judged where not is_link),
passing as (
  select s.config_hash, s.mode0, e.*, e.version || ':' || e.path as k
  from eligible e join sources s on e.source = s.repo_id
  where starts_with(ltrim(e.path, '/'), s.prefix) and regexp_matches(lower(e.path), s.ext_regex)),
failed_before as (
  select s.config_hash, s.repo_id, s.n, s.prefix, s.ext_regex, v.path
  from versions v join sources s on v.source = s.repo_id
  where v.version = 'old' and v.doc_id % 9 in (5, 7) and (s.n % 8 = 1 or s.n % 4 = 2)),
plan as (
  select s.*, f.n_failed,
         case when n % 4 in (0, 3) then 'full' when n % 4 = 2 then 'incremental'
              when f.n_failed > 0 then 'incremental' else 'noop' end as mode
  from sources s left join
       (select config_hash, count(*) as n_failed from failed_before group by 1) f
       on s.config_hash = f.config_hash),
both_sides as (
  select coalesce(o.source, n.source) as repo_id, o.path as op, n.path as np, o.ident as oi, n.ident as ni
  from (select * from eligible where version = 'old') o
  full outer join (select * from eligible where version = 'new') n
  on o.source = n.source and o.path = n.path),
came as (select repo_id, np as path, ni as ident,
                row_number() over (partition by repo_id, ni order by np) as k from both_sides where op is null),
went as (select repo_id, op as path, oi as ident,
                row_number() over (partition by repo_id, oi order by op) as k from both_sides where np is null),
repo_changes as (
  select coalesce(came.repo_id, went.repo_id) as repo_id, went.path as old_path, came.path as new_path,
         case when went.path is null then 'A' when came.path is null then 'D' else 'R' end as status
  from came full outer join went
  on came.repo_id = went.repo_id and came.ident = went.ident and came.k = went.k
  union all
  select repo_id, op, np, 'M' from both_sides
  where op is not null and np is not null and oi <> ni),
sided as (
  select p.config_hash, c.*,
         coalesce(starts_with(c.old_path, p.prefix) and regexp_matches(lower(c.old_path), p.ext_regex), false) as old_ok,
         coalesce(starts_with(c.new_path, p.prefix) and regexp_matches(lower(c.new_path), p.ext_regex), false) as new_ok
  from repo_changes c join plan p on c.repo_id = p.repo_id
  where p.mode = 'incremental' and p.n % 4 = 2),
changed_paths as (
  select config_hash, repo_id, new_path as path, case when status = 'M' then 'update' else 'add' end as action
  from sided where new_ok and status in ('A', 'M', 'R')),
held as (
  select e.config_hash, e.path from passing e join plan p on e.config_hash = p.config_hash
  where p.n % 4 <> 0 and e.version = 'old' and e.doc_id % 7 <> 3
    and (e.outcome = 'ok' or e.doc_id % 13 = 5 and e.outcome in ('binary', 'non_utf8'))
  union
  select config_hash, 'never/listed_' || cast(n as varchar) || '.md' from plan where n % 4 <> 0),
retried as (
  select f.config_hash, f.repo_id, f.path, 'add' as action
  from failed_before f join plan p on f.config_hash = p.config_hash
  where p.mode = 'incremental' and starts_with(f.path, f.prefix) and regexp_matches(lower(f.path), f.ext_regex)),
work as (
  select p.config_hash, e.source as repo_id, e.path, 'add' as action
  from eligible e join plan p on e.source = p.repo_id
  where p.mode = 'full' and e.version = 'new'
    and starts_with(e.path, p.prefix) and regexp_matches(lower(e.path), p.ext_regex)
  union all
  select * from changed_paths
  union all
  select * from retried r
  where not exists (select 1 from changed_paths c where c.config_hash = r.config_hash and c.path = r.path)),
attempts as (
  select w.config_hash, w.path, w.action, coalesce(e.outcome, 'not_found') as outcome,
         coalesce(e.outcome, 'not_found') = 'read_error' as is_transient, e.content
  from work w left join (select * from eligible where version = 'new') e
  on w.repo_id = e.source and w.path = e.path),
delete_feed as (
  select config_hash, old_path as path from sided where old_ok and status in ('D', 'R')
  union
  select h.config_hash, h.path from held h join plan p on h.config_hash = p.config_hash
  where p.mode = 'full' and not exists (
    select 1 from passing e where e.config_hash = h.config_hash and e.version = 'new' and e.path = h.path)
  union
  select h.config_hash, h.path from held h join attempts a on h.config_hash = a.config_hash and h.path = a.path
  where a.outcome <> 'ok' and not a.is_transient
  union
  select 'old-' || config_hash, 'docs/left_' || cast(n as varchar) || '.md' from plan where n % 4 <> 0),
numbered_attempts as (
  select *, row_number() over (partition by config_hash order by path) as attempted,
         coalesce(sum(case when outcome = 'ok' then 1 else 0 end)
           over (partition by config_hash order by path rows between unbounded preceding and 1 preceding), 0)
           as good_before
  from attempts),
batch_rows as (
  select config_hash, path, outcome, is_transient, cast(floor(good_before / 50) as bigint) as batch_no, attempted
  from numbered_attempts)"""
)
