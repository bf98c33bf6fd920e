"""Fixed record layouts as DDL. Streams never infer a schema."""

from __future__ import annotations

SENSOR = "id string, timestamp bigint, temperature double"
USER_BEHAVIOR = "user_id bigint, item_id bigint, category_id int, behavior string, timestamp bigint"
LOGIN = "user_id bigint, ip string, login_state string, timestamp bigint"
AD_CLICK = "user_id bigint, ad_id bigint, province string, city string, timestamp bigint"
MARKETING = "user_id bigint, behavior string, channel string, timestamp bigint"
ORDER_EVENT = "order_id bigint, event_type string, tx_id string, timestamp bigint"
RECEIPT = "tx_id string, pay_channel string, timestamp bigint"
ORDER_INFO = "id int, user_id bigint, total_amount double, create_time bigint"
USER_INFO = "id int, user_id bigint, age int, sex int"

EVENTS = (
    "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"
)

# Nested application log: fixed field names of the record the log carries.
APP_LOG = (
    "ts bigint,"
    "common struct<mid:string,uid:string,vc:string,ch:string,os:string,ar:string,md:string,ba:string,is_new:string>,"
    "start struct<entry:string,open_ad_id:bigint,open_ad_ms:int,open_ad_skip_ms:int,loading_time:int>,"
    "page struct<last_page_id:string,page_id:string,item_type:string,item:string,during_time:int,"
    "extend1:string,extend2:string,source_type:string>,"
    "displays array<struct<item_type:string,item:string,display_type:string,`order`:int,pos_id:int>>,"
    "actions array<struct<action_id:string,item_type:string,item:string,extend1:string,extend2:string,ts:bigint>>,"
    "err struct<error_code:int,msg:string>,"
    "notice struct<notice_id:bigint>"
)
