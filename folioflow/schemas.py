"""StructTypes of the records; the single source of field names and types.

They are written as DDL and parsed when first asked for, as parsing needs a session.
"""

from __future__ import annotations

from pyspark.sql import types as T


def __getattr__(name: str) -> T.StructType:
    try:
        ddl = _RECORDS[name]
    except KeyError:
        raise AttributeError(name) from None
    made = globals()[name] = T._parse_datatype_string(ddl)
    return made


def _ddl(*fields: str) -> str:
    return "struct<" + ",".join(fields) + ">"


_EVENT = _ddl("identifier:string", "type:string", "date_created:timestamp", "fail_count:int", "fail_reason:string", "date_published:timestamp", "partition:int", "offset:bigint", "is_internal_message:boolean")
_SIZE = _ddl("value:double", "unit_text:string")
_DELTA = _ddl("increase:bigint", "decrease:bigint", "sum:bigint", "proportional_increase:double", "proportional_decrease:double")
_DIFF = _ddl("longest_new_repeated_character:int", *(f"{n}_words:{_DELTA}" for n in ("dictionary", "non_dictionary", "non_safe", "informal", "uppercase")), f"size:{_SIZE}")
_EDITOR = _ddl("identifier:bigint", "name:string", "edit_count:bigint", "groups:array<string>", "is_bot:boolean", "is_anonymous:boolean", "is_admin:boolean", "is_patroller:boolean", "has_advanced_rights:boolean", "date_started:timestamp")
_PROBABILITY = _ddl("prediction:boolean", "probability:struct<`true`:double,`false`:double>")
_SURVIVAL = _ddl("min:double", "mean:double", "median:double")
_SCORES = _ddl(f"damaging:{_PROBABILITY}", f"goodfaith:{_PROBABILITY}", f"revertrisk:{_PROBABILITY}", f"referencerisk:struct<reference_count:int,reference_risk_score:double,survival_ratio:{_SURVIVAL}>", "referenceneed:struct<reference_need_score:double>")
_TAGS = _ddl("citation_needed_count:bigint", "pov_count:bigint", "clarification_needed_count:bigint", "update_count:bigint")
_VERSION = _ddl("identifier:bigint", "comment:string", "tags:array<string>", "is_minor_edit:boolean", "is_flagged_stable:boolean", "has_tag_needs_citation:boolean", f"scores:{_SCORES}", f"editor:{_EDITOR}", "number_of_characters:bigint", f"size:{_SIZE}", f"event:{_EVENT}", f"diff:{_DIFF}", "is_breaking_news:boolean", "noindex:boolean", f"maintenance_tags:{_TAGS}")
_RELATION = _ddl("name:string", "url:string")
_ENTITY = _ddl("identifier:string", "url:string", "aspects:array<string>")
_LANGUAGE = _ddl("identifier:string", "name:string", "alternate_name:string", "direction:string")
_NAMESPACE = _ddl("identifier:int", "name:string", "alternate_name:string", "description:string")
_PROJECT = _ddl("name:string", "identifier:string", "url:string", "version:string", "additional_type:string", "code:string", "date_modified:timestamp", f"size:{_SIZE}")
_IMAGE = _ddl("content_url:string", "width:int", "height:int", "alternative_text:string", "caption:string", "thumbnail:struct<content_url:string,width:int,height:int>")

_ARTICLE = _ddl(
    "name:string", "identifier:bigint", "abstract:string", "date_created:timestamp", "date_modified:timestamp",
    "date_previously_modified:timestamp", "protection:array<struct<type:string,level:string,expiry:string>>",
    f"version:{_VERSION}", "previous_version:struct<identifier:bigint,number_of_characters:bigint>",
    "version_identifier:string", "url:string", "watchers_count:int", f"namespace:{_NAMESPACE}",
    f"in_language:{_LANGUAGE}", f"main_entity:{_ENTITY}", f"additional_entities:array<{_ENTITY}>",
    f"categories:array<{_RELATION}>", f"templates:array<{_RELATION}>", f"redirects:array<{_RELATION}>",
    f"is_part_of:{_PROJECT}", "article_body:struct<html:string,wikitext:string>",
    "license:array<struct<name:string,identifier:string,url:string,in_language:string>>",
    "visibility:struct<text:boolean,editor:boolean,comment:boolean>", f"event:{_EVENT}", f"image:{_IMAGE}",
)

#: Recursive parts (sections, infoboxes, nested tables) are JSON text, as Spark has no recursive type.
_STRUCTURED = _ddl(
    "name:string", "identifier:bigint", "abstract:string", "description:string", "version:" + _VERSION, "url:string",
    f"in_language:{_LANGUAGE}", f"is_part_of:{_PROJECT}", f"image:{_IMAGE}", "infoboxes:string", "sections:string",
    "references:array<struct<id:string,index:int,text:string>>",
    "attribution:struct<editors_count:struct<anonymous_count:string,registered_count:string>,parsed_references_count:int,last_revised:string>",
)

_SNAPSHOT = _ddl("name:string", "identifier:string", "version:string", "date_modified:timestamp", f"is_part_of:{_PROJECT}", f"in_language:{_LANGUAGE}", f"namespace:{_NAMESPACE}", f"size:{_SIZE}", "chunks:array<string>")

_CHANGE = _ddl(
    "database:string", "page_change_kind:string", "meta:struct<uri:string,domain:string,dt:timestamp>",
    "page:struct<page_id:bigint,page_title:string,page_namespace:int,page_is_redirect:boolean>",
    "performer:struct<user_id:bigint,user_text:string,user_edit_count:int,user_groups:array<string>,user_is_bot:boolean,user_registration_dt:timestamp>",
    "revision:struct<rev_id:bigint,rev_dt:timestamp,comment:string,is_minor_edit:boolean,rev_size:bigint,is_content_visible:boolean,is_editor_visible:boolean,is_comment_visible:boolean>",
    "prior_state:struct<page:struct<page_title:string,page_namespace:int>,revision:struct<rev_id:bigint>>",
)

#: The log's envelope, as the Kafka source gives it.
_MESSAGE = _ddl("key:binary", "value:binary", "topic:string", "partition:int", "offset:bigint", "timestamp:timestamp")

_RECORDS = {
    "EVENT": _EVENT, "EDITOR": _EDITOR, "VERSION": _VERSION, "PROJECT": _PROJECT, "LANGUAGE": _LANGUAGE, "NAMESPACE": _NAMESPACE,
    "ARTICLE": _ARTICLE, "STRUCTURED": _STRUCTURED, "SNAPSHOT": _SNAPSHOT, "CHANGE": _CHANGE, "MESSAGE": _MESSAGE,
}
