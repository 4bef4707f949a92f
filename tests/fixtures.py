"""A small marketplace with one planted case per rule (bronze-shaped CSV text)."""

BRONZE = {
    "geolocation": """geolocation_zip_code_prefix,geolocation_lat,geolocation_lng,geolocation_city,geolocation_state
1000,-23.0,-46.0,  São Paulo,sp
1000,-23.0,-46.0,  São Paulo,sp
1000,-24.0,-47.0,sao paulo,SP
1000,-25.0,-48.0,osasco,SP
2000,-10.0,-40.0,salvador,BA
2000,-11.0,-41.0,alagoinhas,BA
3000,50.0,-40.0,paris,SP
3000,,-40.0,nulltown,SP
4000,-3.0,-60.0,MANAUS,am
""",
    "customers": """customer_id,customer_unique_id,customer_zip_code_prefix,customer_city,customer_state
c1,u1,1000,SÃO PAULO ,sp
c2,u1,2000,salvador,BA
c3,u2,9999,nowhere,XX
c3,u2,9999,nowhere,XX
c4,u3,4000,manaus,AM
""",
    "sellers": """seller_id,seller_zip_code_prefix,seller_city,seller_state
s1,1000,São Paulo,SP
s2,2000,salvador,ba
s3,8888,lost,ZZ
""",
    "products": """product_id,product_category_name,product_name_lenght,product_description_lenght,product_photos_qty,product_weight_g,product_length_cm,product_height_cm,product_width_cm
p1,beleza_saude,10,100,1,500,10,10,10
p2,beleza_saude,10,100,1,,20,20,20
p3,pc_gamer,10,100,2,12000,50,50,50
p4,sem_traducao,10,100,2,100,1,1,1
p5,,,,,300,30,30,30
p6,sozinho,5,5,5,,,,
""",
    "category_translation": """product_category_name,product_category_name_english
beleza_saude,health_beauty
""",
    "orders": """order_id,customer_id,order_status,order_purchase_timestamp,order_approved_at,order_delivered_carrier_date,order_delivered_customer_date,order_estimated_delivery_date
o1,c1,delivered,2018-01-05 10:00:00,2018-01-05 11:00:00,2018-01-07 10:00:00,2018-01-10 10:00:00,2018-01-20 00:00:00
o2,c2, Delivered ,2018-01-06 10:00:00,2018-01-06 12:00:00,2018-01-08 10:00:00,2018-01-25 10:00:00,2018-01-20 00:00:00
o3,c4,shipped,2018-03-01 10:00:00,2018-03-01 10:30:00,2018-03-02 10:00:00,,2018-03-20 00:00:00
o4,cX,delivered,2018-03-02 10:00:00,2018-03-02 10:30:00,2018-03-04 10:00:00,2018-03-20 10:00:00,2018-03-20 00:00:00
o5,c1,canceled,2018-03-03 10:00:00,,,,2018-03-22 00:00:00
o6,c1,delivered,2018-01-20 10:00:00,2018-01-20 11:00:00,2018-01-21 10:00:00,2018-01-22 10:00:00,2018-02-01 00:00:00
""",
    "order_items": """order_id,order_item_id,product_id,seller_id,shipping_limit_date,price,freight_value
o1,1,p1,s1,2018-01-08 11:00:00,100.00,10.00
o1,1,p2,s1,2018-01-08 11:00:00,999.00,10.00
o1,2,p2,s2,2018-01-09 11:00:00,50.00,40.00
o2,1,p1,s1,2018-01-05 00:00:00,600.00,20.00
o3,1,p3,s2,,80.00,8.00
o4,1,p5,s1,2018-03-04 10:30:00,30.00,3.00
o6,1,p1,s1,2018-01-22 00:00:00,30.00,3.00
oX,1,p1,s1,2018-01-08 11:00:00,10.00,1.00
o6,2,pX,sX,2018-01-22 00:00:00,5.00,0.00
""",
    "order_payments": """order_id,payment_sequential,payment_type,payment_installments,payment_value
o1,1,credit_card,0,150.00
o1,2, Voucher ,1,50.00
o1,2, Voucher ,1,50.00
o2,1,credit_card,3,630.00
o3,1,boleto,1,80.00
o4,1,pix,1,33.00
o6,1,debit_card,1,38.00
oX,1,boleto,1,11.00
""",
    "order_reviews": """review_id,order_id,review_score,review_comment_title,review_comment_message,review_creation_date,review_answer_timestamp
r1,o1,5,,"good, ""very""
good",2018-01-11 00:00:00,2018-01-11 12:00:00
r2,o1,1,,,2018-01-12 00:00:00,2018-01-13 00:00:00
r3,o2,2,,,2018-01-26 00:00:00,
r4,o3,4,,,,
r5,,4,,,2018-01-11 00:00:00,2018-01-12 00:00:00
r6,o4,,,,2018-01-11 00:00:00,2018-01-12 00:00:00
r7,oX,4,,,2018-01-11 00:00:00,2018-01-12 00:00:00
r8,o6,3,,,2018-01-23 00:00:00,2018-01-25 00:00:00
""",
    "marketing_qualified_leads": """mql_id,first_contact_date,landing_page_id,origin
m1,2018-01-01,LP1, Social
m2,2018-01-01,LP1,
m3,2018-01-01,LP2,social
m4,2018-01-01,LP2,paid
,2018-01-01,LP2,paid
""",
    "closed_deals": """mql_id,seller_id,sdr_id,sr_id,won_date,business_segment,lead_type,lead_behaviour_profile,business_type,declared_monthly_revenue
m1,s1,a,b,2018-01-08,Pet,Online,Cat,Reseller,100
m2,s2,a,b,2018-01-31,pet,online,cat,reseller,100
m3,sQ,a,b,2018-02-01,pet,online,cat,reseller,x
m9,s1,a,b,2018-01-02,pet,online,cat,reseller,5
m4,,a,b,2018-02-01,pet,online,cat,reseller,5
""",
}
